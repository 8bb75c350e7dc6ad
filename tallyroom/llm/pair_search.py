"""Ranked lexical search: MaxScore whose bounds are tightened by the joint maxima of term pairs.

``build_index`` cuts the documents into shards of some ``SHARD_BYTES`` of text; a shard is one row
with the postings (document, occurrences) of all its terms, in the narrowest integers that hold
them, since rows of several MB are held many times over on their way. ``collection`` counts documents, terms
and document frequencies. ``weigh`` turns the postings of the terms that are asked for into integer
impacts and stores, per shard, the largest impact of every term and, for pairs of terms, the
largest joint impact in the intersection of their lists. ``search`` answers every query in every shard:

* the terms of a query stand in order of weight; ``bounds[k]`` is what the first k of them can add to
  any document. Alone they add their maxima; two neighbours of the order add at most the pair's
  joint maximum (or the larger of the two maxima, for documents that hold one of them). The
  least sum over all ways to pair neighbours up is the bound;
* terms whose bound stays below the tenth best score so far are never walked; only documents
  of the other lists are candidates, and these are looked up in the lists left over, from the heaviest
  down, while their score and the bound of the rest can still reach the tenth best.

Scores are exact integers, so skipping never changes the result. The best ``top`` of a task are
carried from shard to shard, which raises the threshold; the tasks' lists meet in a window by item.

The queries are the stated set that a table names; they go to the tasks in blocks of
``BLOCK_ITEMS`` expected items. A task holds one shard and one block.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased. With N documents
that hold a term, L terms in all, n terms in a document, and df documents that hold the term:
w = floor(1000 ln((2N + 2) / (2df + 1))), m = 10 + (90 n N) div L, and a term with tf occurrences adds
w * ((1000000000 tf) div (1000 tf + 8m)).

Defined results: a null or empty text has no terms, as document and as item; rows that share a
doc_id are documents of their own; a null doc_id ranks behind equal scores; rows that share an
item_id are one item with the terms of all; an item without any scored document has no rows;
texts are taken whole; empty tables give no rows. Only the named columns are read, so clashing
names cannot matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, slices, utf8, written

SHARD_BYTES = 8 << 20
BLOCK_ITEMS = 2000
TOP = 10

# Digits, letters and all bytes of code points above U+007F; A-Z to a-z, others to a space.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b
               if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

# ``terms``: of the index, joined by spaces, which no term holds. Whole numbers are ``_narrow``; ids,
# term numbers and impacts are 64-bit integers.
_INDEX = ("ids binary, unknown binary, lengths binary, terms binary, starts binary, "
          "docs binary, times binary")
_WEIGHED = ("ids binary, unknown binary, terms binary, starts binary, docs binary, impacts binary, "
            "maxima binary, firsts binary, seconds binary, joint binary")


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _narrow(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 on, in the narrowest type that holds the largest."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _wide(packed, n: int) -> np.ndarray:
    """The ``n`` numbers of a ``_narrow`` array, from its bytes."""
    return np.frombuffer(packed, f"u{len(packed) // n}" if n else np.uint8)


def _cells(batch) -> Iterator[dict]:
    """The rows of a batch of binary columns, as buffers that are not copied."""
    for i in range(batch.num_rows):
        yield {name: column[i].as_buffer()
               for name, column in zip(batch.schema.names, batch.columns, strict=True)}


def _row(names: str, values: list):
    """A batch of one row: arrays as their bytes."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array([v.tobytes() if isinstance(v, np.ndarray) else v], pa.binary()) for v in values],
        names=[c.split()[0] for c in names.split(", ")])


def impact(weight, times, length, n_docs: int, n_terms: int):
    """What a term adds to a document's score; all in 64-bit integers."""
    m = 10 + (90 * length * n_docs) // n_terms
    return weight * ((1_000_000_000 * times) // (1000 * times + 8 * m))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard: ids and lengths of its documents, and the postings of its terms."""
    def run(batches):
        def row(ids, lengths, numbers, words):
            """``words``: the term numbers of all documents, one document after the other."""
            n = len(ids)
            flat = np.concatenate(words)
            owner = np.repeat(np.arange(n), lengths)
            pair, times = np.unique(flat * n + owner, return_counts=True)
            of = pair // n
            starts = np.searchsorted(of, np.arange(len(numbers) + 1))
            unknown = np.array([i is None for i in ids])
            return _row(_INDEX, [np.array([i or 0 for i in ids], np.int64), unknown,
                                 _narrow(np.array(lengths)), b" ".join(numbers), _narrow(starts),
                                 _narrow(pair % n), _narrow(times)])

        ids, lengths, numbers, words, held = [], [], {}, [], 0
        for keys, texts in slices(batches):
            for key, text in zip(keys, texts, strict=True):
                found = terms_of(text)
                if not found:
                    continue
                ids.append(key)
                lengths.append(len(found))
                words.append(np.array([numbers.setdefault(t, len(numbers)) for t in found], np.int64))
                held += len(text)
                if held >= shard_bytes:
                    yield row(ids, lengths, numbers, words)
                    ids, lengths, numbers, words, held = [], [], {}, [], 0
        if ids:
            yield row(ids, lengths, numbers, words)

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), utf8(text_col).alias("text"))
    return bounded(rows).mapInArrow(run, _INDEX)


@dataclass
class Collection:
    """Counts over all documents, with the weights of the terms that are asked for."""

    n_docs: int
    n_terms: int
    weights: dict[bytes, int]


def collection(index: DataFrame, asked: set[bytes]) -> Collection:
    shared = index.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        import pyarrow as pa

        wanted, found, n_docs, n_terms = shared.value, Counter(), 0, 0
        for batch in batches:
            for row in _cells(batch):
                docs = len(row["unknown"])
                n_docs += docs
                n_terms += int(_wide(row["lengths"], docs).sum())
                terms = row["terms"].to_pybytes().split()
                sizes = np.diff(_wide(row["starts"], len(terms) + 1)).tolist()
                for term, size in zip(terms, sizes, strict=True):
                    if term in wanted:
                        found[term] += size
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *found], pa.binary()), pa.array([n_docs, *found.values()], pa.int64()),
             pa.array([n_terms] + [0] * len(found), pa.int64())], names=["term", "n", "more"])

    rows = (index.select("unknown", "lengths", "terms", "starts")
            .mapInArrow(run, "term binary, n bigint, more bigint")
            .groupBy("term").agg(F.sum("n").alias("n"), F.sum("more").alias("more")).collect())
    counts = {None if r.term is None else bytes(r.term): r for r in rows}
    whole = counts.pop(None, None)
    n_docs, n_terms = (whole.n, whole.more) if whole else (0, 0)
    weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.n + 1)))
               for t, r in counts.items()}
    return Collection(n_docs, n_terms, weights)


@dataclass
class Queries:
    """A block of items: the terms they use, by number, in ascending order of weight."""

    items: list
    #: Term numbers of each item, ascending: lighter terms first.
    lists: list[list[int]]
    terms: list[bytes]
    weights: np.ndarray
    pairs: np.ndarray

    @classmethod
    def of(cls, texts: list[tuple], counts: Collection) -> Queries:
        terms = sorted((t for t, w in counts.weights.items() if w > 0),
                       key=lambda t: (counts.weights[t], t))
        number = {t: i for i, t in enumerate(terms)}
        by_item: dict = {}
        for item, words in texts:
            by_item.setdefault(item, set()).update(number[t] for t in words if t in number)
        lists = [sorted(found) for found in by_item.values()]
        # Neighbours in the order of the bounds, of every item.
        pairs = sorted({pair for found in lists for pair in zip(found, found[1:], strict=False)})
        return cls(list(by_item), lists, terms,
                   np.array([counts.weights[t] for t in terms], np.int64),
                   np.array(pairs, np.int64).reshape(-1, 2))


def weigh(index: DataFrame, queries: Queries, counts: Collection) -> DataFrame:
    """Per shard, for the terms of the queries: impacts by document, the largest impact of
    every term, and the largest joint impact of every pair that meets in a document."""
    shared = index.sparkSession.sparkContext.broadcast(
        ({t: i for i, t in enumerate(queries.terms)}, queries.weights, queries.pairs,
         counts.n_docs, counts.n_terms))

    def run(batches):
        number, weights, pairs, n_docs, n_terms = shared.value
        for batch in batches:
            for row in _cells(batch):
                lengths = _wide(row["lengths"], len(row["unknown"])).astype(np.int64)
                terms = row["terms"].to_pybytes().split()
                starts = _wide(row["starts"], len(terms) + 1)
                docs, times = (_wide(row[name], int(starts[-1])) for name in ("docs", "times"))
                lists, gains = {}, {}
                for i, term in enumerate(terms):
                    if (t := number.get(term)) is not None:
                        part = slice(starts[i], starts[i + 1])
                        lists[t] = docs[part]
                        gains[t] = impact(weights[t], times[part].astype(np.int64),
                                          lengths[docs[part]], n_docs, n_terms)
                own = sorted(lists)
                maxima = {t: int(gains[t].max()) for t in own}
                joint = []
                for a, b in pairs.tolist():
                    if a in lists and b in lists:
                        both, at_a, at_b = np.intersect1d(lists[a], lists[b], True, True)
                        if len(both):
                            joint.append((a, b, int((gains[a][at_a] + gains[b][at_b]).max())))
                joint = np.array(joint, np.int64).reshape(-1, 3)
                ends = np.cumsum([0] + [len(lists[t]) for t in own])
                yield _row(_WEIGHED, [
                    row["ids"].to_pybytes(), row["unknown"].to_pybytes(), np.array(own, np.int64),
                    _narrow(ends), np.concatenate([lists[t] for t in own] or [docs[:0]]),
                    np.concatenate([gains[t] for t in own] or [np.zeros(0, np.int64)]),
                    np.array([maxima[t] for t in own], np.int64), *joint.T])

    return index.mapInArrow(run, _WEIGHED)


class Shard:
    """The weighed lists of one shard."""

    def __init__(self, row: dict):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.unknown = read("ids", np.int64), read("unknown", bool)
        terms, impacts = read("terms", np.int64).tolist(), read("impacts", np.int64)
        starts, docs = _wide(row["starts"], len(terms) + 1), _wide(row["docs"], len(impacts))
        self.lists = {t: (docs[a:b], impacts[a:b])
                      for t, a, b in zip(terms, starts.tolist(), starts[1:].tolist(), strict=False)}
        self.maxima = dict(zip(terms, read("maxima", np.int64).tolist(), strict=True))
        self.joint = dict(zip(zip(read("firsts", np.int64).tolist(),
                                  read("seconds", np.int64).tolist(), strict=True),
                              read("joint", np.int64).tolist(), strict=True))
        self.score = np.zeros(len(self.ids), np.int64)

    def bounds(self, found: list[int], pairs: bool = True) -> list[int]:
        """``bounds[k]``: the most that the first k terms add to one document."""
        out = [0]
        for k, t in enumerate(found):
            most = self.maxima.get(t, 0)
            bound = out[k] + most
            if pairs and k:
                before = found[k - 1]
                alone = max(most, self.maxima.get(before, 0))
                bound = min(bound, out[k - 1] + max(alone, self.joint.get((before, t), 0)))
            out.append(bound)
        return out

    def search(self, found: list[int], top: int, least: int,
               pairs: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that can be among the best ``top`` of scores from ``least`` on, with their
        exact scores; and how many postings were looked at."""
        bounds = self.bounds(found, pairs)
        light = 0
        while light < len(found) and bounds[light + 1] < least:
            light += 1
        touched, seen = [], 0
        for t in found[light:]:
            if t in self.lists:
                docs, impacts = self.lists[t]
                self.score[docs] += impacts
                touched.append(docs)
                seen += len(docs)
        if not touched:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), seen
        docs = np.unique(np.concatenate(touched))
        scores = self.score[docs]
        self.score[docs] = 0
        for k in range(light - 1, -1, -1):
            if len(scores) >= top:
                # Scores so far are least values of the whole ones.
                least = max(least, int(np.partition(scores, -top)[-top]))
            open_ = scores + bounds[k + 1] >= least
            docs, scores = docs[open_], scores[open_]
            if found[k] in self.lists and len(docs):
                names, impacts = self.lists[found[k]]
                at = np.searchsorted(names, docs)
                at[at == len(names)] = 0
                scores = scores + np.where(names[at] == docs, impacts[at], 0)
                seen += len(docs)
        return docs, scores, seen


def _best(ids, unknown, scores, top: int):
    """The first ``top`` in the order of the ranking."""
    order = np.lexsort((ids, unknown, -scores))[:top]
    return ids[order], unknown[order], scores[order]


def search(weighed: DataFrame, queries: Queries, top: int = TOP) -> DataFrame:
    """(item, doc_id, score): of every task, each item's best ``top``."""
    shared = weighed.sparkSession.sparkContext.broadcast(queries.lists)

    def run(batches):
        import pyarrow as pa

        lists = shared.value
        none = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
        best = [none] * len(lists)
        for batch in batches:
            for row in _cells(batch):
                shard = Shard(row)
                for i, found in enumerate(lists):
                    ids, unknown, scores = best[i]
                    least = max(1, int(scores[-1])) if len(scores) == top else 1
                    docs, more, _ = shard.search(found, top, least)
                    good = more >= least
                    if good.any():
                        docs = docs[good]
                        best[i] = _best(np.r_[ids, shard.ids[docs]],
                                        np.r_[unknown, shard.unknown[docs]],
                                        np.r_[scores, more[good]], top)
        items = np.repeat(np.arange(len(lists)), [len(b[0]) for b in best])
        if len(items):
            ids, unknown, scores = (np.concatenate(x) for x in zip(*best, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items), pa.array(ids, mask=unknown), pa.array(scores)],
                names=["item", "doc_id", "score"])

    return weighed.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def rank_documents(docs: DataFrame, items: DataFrame, item_col: str = "item_id",
                   item_text_col: str = "text", id_col: str = "doc_id", text_col: str = "text",
                   top: int = TOP, block_items: int = BLOCK_ITEMS,
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``top`` documents."""
    spark = docs.sparkSession
    index = written(build_index(docs, id_col, text_col, shard_bytes), "search-index", alone=True)
    asked = items.select(F.col(f"`{item_col}`").cast("bigint").alias("item_id"),
                         utf8(item_text_col).alias("text"))
    n_blocks = max(1, -(-asked.count() // block_items))
    found = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    for block in range(n_blocks):
        rows = asked.where(_block(n_blocks) == block).collect()
        texts = [(r.item_id, set(terms_of(bytes(r.text)))) for r in rows]
        counts = collection(index, set().union(*(words for _, words in texts)))
        queries = Queries.of(texts, counts)
        if not queries.terms:
            continue
        weighed = written(weigh(index, queries, counts), "search-impacts", alone=True)
        names = spark.createDataFrame(list(enumerate(queries.items)), "item bigint, item_id bigint")
        # As many rows as the block has items.
        hits = search(weighed, queries, top).join(F.broadcast(names), "item")
        found = found.unionByName(hits.select("item_id", "doc_id", "score"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))


def _block(n_blocks: int) -> Column:
    return F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
