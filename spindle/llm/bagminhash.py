"""BagMinHash: near-duplicates by weighted Jaccard similarity of word shingles.

Signature.  A shingle with weight w (its count) owns the interval (0, w], cut into the
dyadic levels (0,1], (1,2], (2,4], ...  Each (shingle, level) is a Poisson process whose
rate is the level's length; a point has a time, a position in the signature and a unit
of the level, and counts for a text only if its unit lies within w, so texts with
different weights share the points of their common part.  A position's least time is a
sample of the weighted union, equal in two texts with probability sum(min)/sum(max).
Points are drawn by increasing time for all processes at once; a process stops when its
time passes the largest entry of its text's signature.

Candidates.  The signature is cut into bands; texts that share a band meet, and are
suspects if their whole signatures agree in at least ``agreement`` of the positions.

Verification.  Exact weighted Jaccard over the whole shingle multisets, 0.8 or more,
within each component of suspects.

Texts with the same multiset are one class (copies are never paired).  Both steps work
through ``clusters.linked``: members of a group are compared with its first member, and
only those that differ from it with all others, in blocks; no group is capped, and no
pair is skipped unless its members are joined already.

Defined cases: null text counts as empty; a text without words is a class of its own
row and links to nothing; repeated rows are copies; an empty table gives an empty
result; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.clusters import agreeing_marks, jaccard_sets, linked
from spindle.llm.common import body, free_name, keep
from spindle.llm.components import connected_components
from spindle.llm.shingles import expanded, mix, multisets, shingle_hashes
from spindle.operators.joins import checked_broadcast

BANDS, ROWS = 32, 4
SIMILARITY = 0.8
AGREEMENT = 0.6  # of the signature; a pair at 0.8 falls below with a probability under 1e-7
BATCH_BYTES = 1_000_000

_MASK = (1 << 64) - 1
_ROUND, _LEVEL, _PLACE = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def signatures(hashes: np.ndarray, owner: np.ndarray, weight: np.ndarray, n_texts: int, length: int) -> np.ndarray:
    """Times of shape (n_texts, length); infinite for texts without shingles.  ``length`` is a power of two."""
    sig = np.full((n_texts, length), np.inf)
    flat, limit = sig.ravel(), np.full(n_texts, np.inf)
    levels = [(hashes, owner, weight, 0)]
    k, at = 1, np.flatnonzero(weight > 1)
    while len(at):
        levels.append((hashes[at] + np.uint64(k * int(_LEVEL) & _MASK), owner[at], weight[at], k))
        at = at[weight[at] > (1 << k)]
        k += 1
    seed = np.concatenate([mix(x[0]) for x in levels])
    own = np.concatenate([x[1] for x in levels])
    upto = np.concatenate([x[2] for x in levels])
    base = np.concatenate([np.full(len(x[0]), (1 << x[3]) >> 1, np.int64) for x in levels])
    span = np.maximum(base, 1)
    time = np.zeros(len(seed))
    step = 0
    while len(seed):
        step += 1
        draw = mix(seed + np.uint64(step * int(_ROUND) & _MASK))
        time = time - np.log((draw >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / span
        live = np.flatnonzero(time < limit[own])
        if len(live) < len(seed):
            seed, own, upto, base, span, time, draw = (x[live] for x in (seed, own, upto, base, span, time, draw))
        place = mix(draw ^ _PLACE)
        unit = base + 1 + ((place >> np.uint64(32)).astype(np.int64) * span >> 32)
        hit = np.flatnonzero(unit <= upto)
        spot = own[hit] * length + (place[hit] & np.uint64(length - 1)).astype(np.int64)
        np.minimum.at(flat, spot, time[hit])
        touched = np.unique(own)
        limit[touched] = sig[touched].max(axis=1)
    return sig


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``BATCH_BYTES`` characters."""
    low, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= BATCH_BYTES:
            yield low, at + 1
            low, size = at + 1, 0
    if low < len(texts):
        yield low, len(texts)


def _signer(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rest = batch.drop_columns(["text"])
            for low, high in _chunks(texts):
                hashes, owner = shingle_hashes(texts[low:high])
                distinct, own, count = multisets(hashes, owner)
                n = high - low
                sig = signatures(distinct, own, count, n, bands * rows)
                bits = sig.view(np.uint64).reshape(n, bands, rows)
                key = np.zeros((n, bands), np.uint64)
                for r in range(rows):
                    key = mix(key ^ bits[:, :, r])
                key = mix(key + np.arange(bands, dtype=np.uint64))
                size = np.bincount(owner, minlength=n)
                sums = []
                for salt in (1, 2):
                    total = np.zeros(n, np.uint64)
                    np.add.at(total, own, mix(distinct + np.uint64(salt)) * count.astype(np.uint64))
                    sums.append(total)
                marks = (mix(bits.reshape(n, -1)) & np.uint64(255)).astype(np.uint8)
                made = [pa.array(size, pa.int64()), *(pa.array(s.view(np.int64), pa.int64()) for s in sums),
                        pa.array(list(key.view(np.int64)), pa.list_(pa.int64())),
                        pa.array([m.tobytes() for m in marks], pa.binary())]
                part = rest.slice(low, n)
                yield pa.RecordBatch.from_arrays([*part.columns, *made],
                                                 names=[*part.schema.names, "size", "key_a", "key_b", "bands", "marks"])

    return run


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        rest = batch.drop_columns(["text"])
        for low, high in _chunks(texts):
            values, owner = expanded(*shingle_hashes(texts[low:high]))
            ends = np.cumsum(np.bincount(owner, minlength=high - low))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()),
                                             pa.array(values.view(np.int64), pa.int64()))
            yield rest.slice(low, high - low).append_column("elements", lists)


def sign_documents(documents: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: its text's key, multiset key and size, band keys and signature marks; written once."""
    named = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                             F.md5(F.encode(body(), "UTF-8")).alias("text_key"), body().alias("text"))
    return keep(named.mapInArrow(_signer(bands, rows),
                                 "row bigint, doc_id bigint, text_key string, size bigint, key_a bigint, key_b bigint, "
                                 "bands array<bigint>, marks binary"), "bag-signatures")


def _near_hub(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """Rows whose marks agree with their hub's."""
    for batch in batches:
        if len(batch):
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(len(batch), -1)
                    for c in ("marks", "hub_marks"))
            yield batch.filter(pa.array((a == b).mean(axis=1) >= share)).select(["grp", "id"])


def _signature_links(classes: DataFrame, share: float) -> DataFrame:
    """Links between classes that share a band and whose signatures agree in ``share`` of their positions."""
    meet = classes.select("class", F.explode("bands").alias("grp"))
    shared = meet.groupBy("grp").agg(F.min("class").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = keep(meet.join(shared.select("grp", "hub"), "grp"), "bag-buckets")
    marks = classes.select("class", "marks")
    members = keep(met.join(marks, "class").select("grp", "hub", F.col("class").alias("id"), "marks"), "bag-members")
    hubs = members.filter("id = hub").select("grp", F.col("marks").alias("hub_marks"))
    matches = keep(members.filter("id != hub").join(hubs, "grp").select("grp", "id", "marks", "hub_marks")
                   .mapInArrow(lambda b: _near_hub(b, share), "grp bigint, id bigint"), "bag-hub-marks")
    return linked(members.drop("hub"), matches, agreeing_marks(share), "marks")


def _elements(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, elements): the expanded shingle multisets of the wanted classes, from their first documents' texts."""
    texts = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("known"),
                             F.md5(F.encode(body(), "UTF-8")).alias("text_key"), body().alias("text"))
    keys = wanted.select("class", "text_key", F.coalesce("doc_id", F.lit(-1)).alias("known"))
    return (texts.join(checked_broadcast(keys, "text_key"), ["known", "text_key"]).select("class", "text")
            .groupBy("class").agg(F.first("text").alias("text"))
            .mapInArrow(_expand, "class bigint, elements array<bigint>"))


def _verified_links(members: DataFrame, similarity: float) -> DataFrame:
    """Links of exact similarity that connect what such links connect within the components of signatures.

    A component is named by its least member, which is the hub that all others are compared with.
    """
    hubs = members.filter("id = grp").select("grp", F.col("elements").alias("of_hub"))
    shared = F.size(F.array_intersect("elements", "of_hub"))
    matches = keep(members.filter("id != grp").join(hubs, "grp").withColumn("shared", shared)
                   .filter(F.col("shared") >= similarity * (F.size("elements") + F.size("of_hub") - F.col("shared")) - 1e-6)
                   .select("grp", "id"), "bag-hub-exact")
    return linked(members, matches, jaccard_sets(similarity), "elements")


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
                    agreement: float = AGREEMENT) -> DataFrame:
    """One row per document: ``row`` (unique), ``doc_id``, ``text_key``, ``class`` (the row number of the first
    document with the same multiset) and ``group`` (the least class connected to it by links), with the least
    doc_id of both (``class_doc``, ``group_doc``).

    The first document is the one with the least doc_id, nulls last.
    """
    signed = sign_documents(documents, bands, rows)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "text_key")).alias("first")
    classes = keep(signed.filter("size > 0").groupBy("key_a", "key_b", "size")
                   .agg(first, F.min_by("bands", "row").alias("bands"), F.min_by("marks", "row").alias("marks"))
                   .select(F.col("first.row").alias("class"), "first.doc_id", "first.text_key",
                           "key_a", "key_b", "size", "bands", "marks"), "bag-classes")
    suspects = connected_components(_signature_links(classes, agreement))
    wanted = keep(suspects.withColumnRenamed("node", "class").join(classes, "class")
                  .select("class", "component", "doc_id", "text_key"), "bag-suspects")
    members = keep(_elements(documents, wanted).join(wanted.select("class", "component"), "class")
                   .select(F.col("component").alias("grp"), F.col("class").alias("id"), "elements"), "bag-elements")
    groups = connected_components(_verified_links(members, similarity))
    placed = (classes.select("class", F.col("doc_id").alias("class_doc"), "key_a", "key_b", "size")
              .join(groups.withColumnRenamed("node", "class"), "class", "left")
              .withColumn("group", F.coalesce("component", "class")))
    names = placed.groupBy("group").agg(F.min("class_doc").alias("group_doc"))
    placed = placed.join(names, "group").select("class", "class_doc", "group", "group_doc", "key_a", "key_b", "size")
    alone = lambda c, own: F.when(F.col("class").isNull(), F.col(own)).otherwise(F.col(c)).alias(c)
    return (signed.join(placed, ["key_a", "key_b", "size"], "left")
            .select("row", "doc_id", "text_key", alone("group", "row"), alone("class_doc", "doc_id"),
                    alone("group_doc", "doc_id"), alone("class", "row")))


def first_of_each_group(documents: DataFrame, **options) -> DataFrame:
    """The rows of ``documents``, all columns, that are the first of their near-duplicate group.

    The first has the least doc_id, nulls last; copies of one row keep one of them.
    """
    grouped = near_duplicates(documents, **options)
    firsts = (grouped.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row",
                                                          "text_key")).alias("first"))
              .select("first.doc_id", "first.text_key"))
    known, key = free_name(documents, "_known"), free_name(documents, "_key")
    marked = documents.withColumns({known: F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)),
                                    key: F.md5(F.encode(body(), "UTF-8"))})
    chosen = firsts.select(F.coalesce("doc_id", F.lit(-1)).alias(known), F.col("text_key").alias(key))
    return (marked.join(chosen, [known, key], "left_semi").dropDuplicates([known, key])
            .select(*(F.col(f"`{c}`") for c in documents.columns)))
