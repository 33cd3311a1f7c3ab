r"""Ranked lexical search by scanning the documents with an Aho-Corasick automaton.

No document index is built.  The distinct terms of the items become one automaton whose
patterns carry a guard on either side: texts are mapped byte by byte to a form in which
every separator is one blank and A-Z are lower case, and the pattern of a term is
``blank term blank``, so a match is a whole term and its count the term frequency.  The
automaton is broadcast; its outputs are term numbers, which map to the items that hold
the term.

Two scans: the first counts documents, terms and document frequencies (a task sends one
row per term), the second scores every document for every item and keeps each task's
``k`` best per item; those are merged in two steps (first within a hash of the task).

Items go through in blocks of at most ``BLOCK_CHARS`` characters of terms or
``BLOCK_ITEMS`` items (one item more, if it alone is larger), each with its own
automaton and scans.  That bounds what is broadcast and collected, whatever the number
of items.

A term is a maximal match of ``TERM``.  With N documents that hold a term, L terms in
all of them, n in one of them, document frequency df and term frequency tf:
w = floor(1000 ln((2N + 2) / (2df + 1))), m = 50 + (50 n N) div L, and the score is the
sum of w * ((10^9 tf) div (1000 tf + 20 m)) over the item's terms, once each.

Defined cases: null text has no term; items without terms have no rows, nor does an
empty table; rows with the same item_id (null included) are one item with the terms of
all; repeated documents are ranked each; equal scores go by doc_id, null last; extra
columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from string import ascii_lowercase, ascii_uppercase

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm.common import empty_frame, keep

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 50
BLOCK_CHARS, BLOCK_ITEMS = 200_000, 512
SLICE_BYTES, SLICE_DOCS = 1 << 20, 512
MERGE_GROUPS = 256
RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"
N_DOCS, N_TERMS = -1, -2  # rows of the first scan beside the terms' own

_IN_TERM = np.array([bytes([c]).isalnum() or c >= 128 for c in range(256)])
_MAPPED = bytes(ord(chr(c).lower()) if c < 128 and _IN_TERM[c] else c if _IN_TERM[c] else 32 for c in range(256))


@dataclass
class Block:
    """Items with their terms: numbered terms, and which item holds which."""

    item_ids: list[int | None] = field(default_factory=list)
    terms: dict[str, int] = field(default_factory=dict)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    chars: int = 0

    def add(self, item_id: int | None, terms: list[str]) -> None:
        item = len(self.item_ids)
        self.item_ids.append(item_id)
        for t in terms:
            if t not in self.terms:
                self.terms[t] = len(self.terms)
                self.chars += len(t)
            self.pairs.append((self.terms[t], item))

    def full(self) -> bool:
        return self.chars >= BLOCK_CHARS or len(self.item_ids) >= BLOCK_ITEMS

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, number in self.terms.items():
            found.add_word(f" {term} ".encode("utf-8", "surrogatepass").decode("latin-1"), number)
        found.make_automaton()
        return found

    def holds(self) -> np.ndarray:
        """Term by item, 1 where the item holds the term."""
        table = np.zeros((len(self.terms), len(self.item_ids)), np.uint8)
        at = np.array(self.pairs)
        table[at[:, 0], at[:, 1]] = 1
        return table


def item_blocks(items: DataFrame) -> Iterator[Block]:
    """The items in blocks, read one partition at a time."""
    lowered = F.translate(F.col("text"), ascii_uppercase, ascii_lowercase)
    terms = items.select(F.col("item_id").cast("long").alias("item_id"),
                         F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
    grouped = keep(terms.groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))
                   .orderBy("item_id"), "lexical-items")
    block = Block()
    for row in grouped.orderBy("item_id").toLocalIterator():
        block.add(row["item_id"], row["terms"])
        if block.full():
            yield block
            block = Block()
    if block.item_ids:
        yield block


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    low, size = 0, 0
    for i, t in enumerate(texts):
        if i > low and (size + len(t) > SLICE_BYTES or i - low == SLICE_DOCS):
            yield low, i
            low, size = i, 0
        size += len(t)
    if low < len(texts):
        yield low, len(texts)


def scan(texts: list[str], automaton: ahocorasick.Automaton, n_terms: int
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and the matches as (text, term, frequency), ordered by text and term."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.cumsum([1, *(len(p) + 1 for p in parts)])
    mapped = b"".join([b" ", b" ".join(parts), b" "]).translate(_MAPPED)
    inside = _IN_TERM[np.frombuffer(mapped, np.uint8)]
    begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    sizes = np.bincount(np.searchsorted(starts, begins, side="right") - 1, minlength=len(texts))
    hits = np.fromiter(automaton.iter(mapped.decode("latin-1")), dtype=[("end", np.int64), ("term", np.int64)])
    text_of = np.searchsorted(starts, hits["end"] - 1, side="right") - 1
    found, tf = np.unique(text_of * n_terms + hits["term"], return_counts=True)
    return sizes, found // n_terms, found % n_terms, tf


def _counter(automaton, n_terms: int):
    """One row per term of a task with its documents, and the documents with terms and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, total = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in _slices(texts):
                sizes, _, term, _ = scan(texts[low:high], automaton.value, n_terms)
                df += np.bincount(term, minlength=n_terms)
                docs += int((sizes > 0).sum())
                total += int(sizes.sum())
        here = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*here.tolist(), N_DOCS, N_TERMS], pa.int32()),
             pa.array([*df[here].tolist(), docs, total], pa.int64())], names=["term", "n"])

    return run


@dataclass(frozen=True)
class Weights:
    """What the scores need from the first scan."""

    n_docs: int
    n_terms: int
    w: np.ndarray

    def length_factor(self, sizes: np.ndarray) -> np.ndarray:
        if len(sizes) and 50 * int(sizes.max()) * self.n_docs >= 2**63:
            return np.array([50 + (50 * int(n) * self.n_docs) // self.n_terms for n in sizes], np.int64)
        return 50 + (50 * sizes.astype(np.int64) * self.n_docs) // self.n_terms


class Best:
    """The ``k`` best documents of every item seen so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.rows = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]  # item, score, doc_id, doc_id is null
        self.pruned = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """``scores`` of documents by items."""
        doc, item = np.nonzero(scores >= self.least)
        new = [item, scores[doc, item], ids[doc], missing[doc]]
        self.rows = [np.concatenate(pair) for pair in zip(self.rows, new, strict=True)]
        if len(self.rows[0]) > 2 * self.pruned + 4096:
            self.prune()

    def prune(self) -> None:
        item, score, ids, missing = self.rows
        order = np.lexsort((ids, missing, -score, item))
        first = np.searchsorted(item[order], item[order])
        place = np.arange(len(order)) - first
        kept = order[place < self.k]
        last = order[place == self.k - 1]
        self.least[item[last]] = score[last]
        self.rows, self.pruned = [x[kept] for x in self.rows], len(kept)


def item_scores(weights: Weights, holds: np.ndarray, sizes: np.ndarray, text: np.ndarray, term: np.ndarray,
                tf: np.ndarray) -> np.ndarray:
    """Exact scores, texts by items, of matches (text, term, frequency)."""
    m = weights.length_factor(sizes)
    part = weights.w[term] * ((1_000_000_000 * tf.astype(np.int64)) // (1000 * tf + 20 * m[text]))
    used, column = np.unique(term, return_inverse=True)
    # sums below 2^53 are exact in doubles, whose product is the fast one
    most = int(weights.w.max(initial=0)) * 1_000_000 * len(used)
    kind = np.float64 if most < 2**53 else np.int64
    table = np.zeros((len(sizes), len(used)), kind)
    table[text, column] = part
    return (table @ holds[used].astype(kind)).astype(np.int64)


def _ranker(automaton, holds, weights, item_ids: list[int | None], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(item_ids), k)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = batch.column("doc_id")
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for low, high in _slices(texts):
                scores = item_scores(weights.value, holds.value,
                                     *scan(texts[low:high], automaton.value, len(weights.value.w)))
                best.add(scores, ids[low:high], missing[low:high])
        best.prune()
        item, score, ids, missing = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([item_ids[i] for i in item], pa.int64()), pa.array(ids, pa.int64(), mask=missing),
             pa.array(score, pa.int64())], names=["item_id", "doc_id", "score"])

    return run


def _ranked_block(texts: DataFrame, block: Block, k: int) -> DataFrame | None:
    sc = texts.sparkSession.sparkContext
    n = len(block.terms)
    automaton = sc.broadcast(block.automaton())
    counted = {r["term"]: r["n"] for r in (  # at most n + 2 rows
        texts.select("text").mapInArrow(_counter(automaton, n), "term int, n bigint")
        .groupBy("term").agg(F.sum("n").alias("n")).collect())}
    n_docs, n_terms = counted.pop(N_DOCS, 0), counted.pop(N_TERMS, 0)
    if not n_docs:
        return None
    w = np.zeros(n, np.int64)
    for term, df in counted.items():
        w[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    weights, holds = sc.broadcast(Weights(n_docs, n_terms, w)), sc.broadcast(block.holds())
    return texts.mapInArrow(_ranker(automaton, holds, weights, block.item_ids, k),
                            "item_id bigint, doc_id bigint, score bigint")


def rank_documents(documents: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``k`` best documents of every item."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = None
    for block in item_blocks(items):
        ranked = _ranked_block(texts, block, k)
        if ranked is None:
            break  # no document has a term
        ranked = keep(ranked.withColumn("task", F.spark_partition_id() % MERGE_GROUPS), "lexical-best")
        found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        return empty_frame(documents.sparkSession, RESULT)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    place = F.row_number().over(Window.partitionBy("item_id", "task").orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return (found.withColumn("place", place).filter(F.col("place") <= k)
            .withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
