"""Exact top-k search by BM25: an inverted index in shards, and products of queries with it.

A shard is the index of some thousand documents: postings by term. Terms that many documents hold have rows of all
documents: a product of matrices gives their part of all scores for many queries. Queries of a kind go together, and a term
takes part in their product if enough of them hold it; else its postings are summed by document, as those of rare terms
are. That is done in single precision, whose error is bounded as nothing is subtracted, and what may be among the best is
summed again in double precision. Bounds for blocks of documents would not pay: a rare term's block holds little more than
one posting, so a bound reads about as much as the score. A task goes through several shards and hands over the best of all
of them, and a document has to reach the scores found so far. Document frequencies, number and length of documents are
those of all shards together, so the tasks' results merge exactly. Queries come in blocks of bounded size.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import scratch, slices, stored, table, word_hashes

TOP = 10
K1, B = 1.2, 0.75
#: Documents of a shard (their numbers fit 16 bits), and postings after which a shard ends early.
SHARD_DOCS = 8_192
SHARD_POSTINGS = 4_000_000
#: Share of a shard's documents from which a term has a row of all documents.
DENSE = 1 / 24
#: Postings that are taken together; a list of less than half as many is taken one by one.
WIDTH = 16
#: How many terms of a product's sums cost as much as a posting.
PRODUCT_GAIN = 150
#: Terms of the queries of a block, about: its broadcast is 4 bytes for each, and 16 for each distinct one.
QUERY_TERMS = 3_000_000
#: Queries in the whole table are the documents whose identifier divides by this.
EVERY = 50
#: Queries whose products are computed together; they are put in order by kind, told by their common terms.
TOGETHER = 256
KINDS = 16
KIND_TERMS = 256
#: Scores are rounded to so many digits, far above their errors; a bound must be lower by more than the rounding to be passed over.
DIGITS = 6
_CLOSE = 1e-5
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

INDEX_DDL = "n_docs bigint, n_words bigint, postings binary"
RESULT_DDL = "query bigint, version int, doc_id bigint, score double"


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct words of a text in order, and how often each occurs."""
    terms, counts = np.unique(word_hashes((text or "").encode()), return_counts=True)
    return terms, counts.astype(np.uint32)


def _packed(**arrays: np.ndarray) -> bytes:
    parts = [pa.compress(pa.py_buffer(np.ascontiguousarray(a)), codec="zstd") for a in arrays.values()]
    heads = [(name, a.dtype.str, a.nbytes, p.size) for (name, a), p in zip(arrays.items(), parts, strict=True)]
    head = json.dumps(heads).encode()
    return b"".join([np.int64(len(head)).tobytes(), head, *parts])


def _unpacked(data: pa.Buffer) -> dict[str, np.ndarray]:
    start = 8 + int(np.frombuffer(data, np.int64, 1)[0])
    out = {}
    for name, kind, size, packed in json.loads(data[8:start].to_pybytes()):
        out[name] = np.frombuffer(pa.decompress(data[start : start + packed], size, codec="zstd"), kind)
        start += packed
    return out


def _shard(ids: list, bags: list[tuple[np.ndarray, np.ndarray]]) -> tuple[int, int, bytes]:
    """The shard of documents with these identifiers and words."""
    known = np.array([i is not None for i in ids])
    numbers = np.array([0 if i is None else i for i in ids], np.int64)
    sizes = np.array([int(b[1].sum()) for b in bags], np.int64)
    terms, counts = (np.concatenate([b[i] for b in bags]) for i in (0, 1))
    docs = np.repeat(np.arange(len(bags), dtype=np.uint16), [len(b[0]) for b in bags])
    order = np.argsort(terms, kind="stable")
    terms, docs, counts = terms[order], docs[order], counts[order].astype(np.uint32)
    del order
    head = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.empty(0, np.int64)
    starts = np.append(head, len(terms)).astype(np.int32)
    terms = terms[head]
    return len(ids), int(sizes.sum()), _packed(ids=numbers, known=known, sizes=sizes, terms=terms, starts=starts, docs=docs, counts=counts)


def build_index(docs: DataFrame) -> DataFrame:
    """The shards (``INDEX_DDL``) of ``docs`` (``doc_id``, ``text``), made where the documents are read; no shuffle."""

    def index(batches):
        ids, bags, postings = [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    bag = term_counts(text)
                    ids.append(doc_id)
                    bags.append(bag)
                    postings += len(bag[0])
                    if len(ids) == SHARD_DOCS or postings >= SHARD_POSTINGS:
                        yield _index_batch(_shard(ids, bags))
                        ids, bags, postings = [], [], 0
        if ids:
            yield _index_batch(_shard(ids, bags))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(index, INDEX_DDL)


def _index_batch(row: tuple[int, int, bytes]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=["n_docs", "n_words", "postings"])


def document_frequencies(index: DataFrame) -> DataFrame:
    """``term`` and ``df`` over all shards."""

    def count(batches):
        for batch in batches:
            for blob in batch.column("postings"):
                own = _unpacked(blob.as_buffer())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own["terms"].view(np.int64)), pa.array(np.diff(own["starts"]).astype(np.int64))], names=["term", "df"]
                )

    return index.select("postings").mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def weighted_queries(queries: DataFrame, frequencies: DataFrame, n_docs: int) -> DataFrame:
    """``query``, ``version``, ``terms`` and ``weights`` of ``queries`` (``query``, ``text``): distinct words that the index holds, by hash, and their idf."""

    def split(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                bags = [term_counts(t)[0].view(np.int64) for t in part.column("text").to_pylist()]
                sizes = [len(b) for b in bags]
                at = np.repeat(np.arange(len(bags)), sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("query").take(pa.array(at)), part.column("version").take(pa.array(at)), pa.array(np.concatenate(bags) if bags else [], pa.int64())],
                    names=["query", "version", "term"],
                )

    asked = queries.select(F.col("query").cast("bigint").alias("query"), F.hash("text").alias("version"), "text")
    terms = asked.mapInArrow(split, "query bigint, version int, term bigint").distinct()
    # words of most documents are asked for by most queries: the side of one row per term is the smaller one, and hot keys are split
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    found = terms.join(frequencies, "term").select("query", "version", F.struct("term", idf.alias("idf")).alias("t"))
    grouped = found.groupBy("query", "version").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return grouped.select("query", "version", F.col("ts.term").alias("terms"), F.col("ts.idf").alias("weights"))


class Asked:
    """Queries as shards take them: ``terms`` and ``weights`` are the pairs that queries hold, by term; ``places`` are those of
    each query among them, ``bounds`` where each query's begin."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, places: np.ndarray, bounds: np.ndarray):
        self.terms, self.weights, self.places, self.bounds = terms, weights, places, bounds

    @staticmethod
    def of(terms: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> Asked:
        """From the terms and weights of all queries one after another."""
        order = np.lexsort((weights, terms))
        terms, weights = terms[order], weights[order]
        new = np.append(True, (terms[1:] != terms[:-1]) | (weights[1:] != weights[:-1]))[: len(terms)]
        places = np.empty(len(terms), np.int32)
        places[order] = np.cumsum(new) - 1
        return Asked(terms[new], weights[new], places, bounds)

    def __len__(self):
        return len(self.bounds) - 1

    def in_order(self, order: np.ndarray) -> Asked:
        """The same queries in another order."""
        sizes = np.diff(self.bounds)[order]
        return Asked(self.terms, self.weights, self.places[_ranges(self.bounds[:-1][order], sizes)], np.append(0, np.cumsum(sizes)))


def alike(asked: Asked) -> np.ndarray:
    """An order of queries in which those that share common terms are neighbours; it decides on time, not on results."""
    n, held = len(asked), np.bincount(asked.places, minlength=len(asked.terms))
    if not n:
        return np.empty(0, np.int64)
    common = np.argsort(-held, kind="stable")[:KIND_TERMS]
    column = np.full(len(held), -1)
    column[common] = np.arange(len(common))
    sizes = np.diff(asked.bounds)
    of, at = np.repeat(np.arange(n), sizes), column[asked.places]
    points = np.zeros((n, len(common)), np.float32)
    points[of[at >= 0], at[at >= 0]] = 1
    points *= np.log((n + 1) / held[common]).astype(np.float32)
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
    pick = np.random.default_rng(0)
    centres = points[pick.choice(n, min(n, KINDS), replace=False)]
    for _ in range(5):
        kinds = np.argmax(points @ centres.T, axis=1)
        sums = np.array([points[kinds == k].sum(axis=0) for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return np.lexsort((sizes, kinds))


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers from each of ``first``, as many as its entry in ``sizes`` says."""
    out = np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
    out += np.arange(len(out))
    return out


class Shard:
    """A shard in memory, ready for queries."""

    def __init__(self, blob: bytes | pa.Buffer, mean_size: float):
        own = _unpacked(pa.py_buffer(blob))
        self.ids, self.known, self.terms, self.docs = own["ids"], own["known"], own["terms"], own["docs"]
        starts, counts = own["starts"].astype(np.int64), own["counts"]
        self.n, self.first, self.size = len(self.ids), starts[:-1], np.diff(starts)
        # the same postings by document
        by_doc = np.argsort(self.docs, kind="stable").astype(np.int32)
        self.doc_counts = counts.take(by_doc)
        self.doc_terms = np.repeat(np.arange(len(self.size), dtype=np.int32), self.size).take(by_doc)
        self.doc_first = np.append(0, np.cumsum(np.bincount(self.docs, minlength=self.n)))
        del by_doc
        # what a document's length adds to the counts of its words
        self.length = K1 * (1 - B + B * own["sizes"] / mean_size)
        self.impact = counts.astype(np.float32)
        self.impact /= self.impact + self.length.astype(np.float32).take(self.docs)
        self.impact *= np.float32(K1 + 1)
        # of the query whose scores are summed: its terms by the last bits of their numbers, and their weights
        self.asked, self.weight = np.zeros(1 << 16, bool), np.zeros(len(self.terms))

    def search(
        self, queries: Asked | list[tuple[np.ndarray, np.ndarray]], top: int, least: np.ndarray | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each of ``queries`` (a list has their terms and weights) document numbers and scores of the ``top`` best, and
        of those as good as the last, as far as they reach the query's entry in ``least``."""
        asked = queries
        if not isinstance(queries, Asked):
            flat = (np.concatenate([q[i] for q in queries] or [np.empty(0)]).astype(t) for i, t in enumerate((np.uint64, float)))
            asked = Asked.of(*flat, np.append(0, np.cumsum([len(t) for t, _ in queries])))
        least = np.zeros(len(asked)) if least is None else least
        at = np.minimum(np.searchsorted(self.terms, asked.terms), max(len(self.terms) - 1, 0))
        here = np.flatnonzero(self.terms[at] == asked.terms) if len(self.terms) else np.empty(0, np.int64)
        place = np.full(len(asked.terms), -1, np.int32)
        place[here] = np.arange(len(here))
        at, weights = at[here], asked.weights[here]
        size, first = self.size[at], self.first[at]
        # lists of postings in rows of equal length, with scores instead of impacts
        wide = size >= WIDTH // 2
        rows = np.where(wide, -(-size // WIDTH), 0)
        row = np.cumsum(rows) - rows
        row_docs, row_scores = np.zeros(int(rows.sum()) * WIDTH, np.uint16), np.zeros(int(rows.sum()) * WIDTH, np.float32)
        lists = np.flatnonzero(wide)
        for t in np.array_split(lists, 1 + int(size[lists].sum()) // 500_000):
            source, target = _ranges(first[t], size[t]), _ranges(row[t] * WIDTH, size[t])
            row_docs[target] = self.docs.take(source)
            row_scores[target] = self.impact.take(source) * np.repeat(weights[t].astype(np.float32), size[t])
        row_docs, row_scores = row_docs.reshape(-1, WIDTH), row_scores.reshape(-1, WIDTH)
        # and as a row of all documents, where a list is long
        common = np.flatnonzero(size >= max(2, DENSE * self.n))
        line = np.full(len(here), -1)
        line[common] = np.arange(len(common))
        lines = np.zeros((len(common), self.n), np.float32)
        for i, t in enumerate(common.tolist()):
            mine = slice(first[t], first[t] + size[t])
            lines[i, self.docs[mine]] = self.impact[mine] * weights[t]
        for begin in range(0, len(asked), TOGETHER):
            n = min(TOGETHER, len(asked) - begin)
            bounds = asked.bounds[begin : begin + n + 1]
            own = place[asked.places[bounds[0] : bounds[-1]]]
            of = np.repeat(np.arange(n), np.diff(bounds))[own >= 0]
            own = own[own >= 0]
            # a line serves all queries at a price that does not depend on how many hold its term
            mine = line[own]
            held = np.bincount(mine[mine >= 0], minlength=len(common))
            worth = held * size[common] * PRODUCT_GAIN >= n * self.n
            chosen = np.flatnonzero(worth)
            by_line = np.append(worth, False)[mine]
            holds = np.zeros((n, len(common)), np.float32)
            holds[of[by_line], mine[by_line]] = 1
            scores = holds[:, chosen] @ lines[chosen]
            by_row = ~by_line & wide[own]
            short = ~by_line & ~wide[own]
            t, q = own[short], of[short]
            postings = _ranges(first[t], size[t])
            cells = np.repeat(q * self.n, size[t])
            cells += self.docs.take(postings)
            np.add.at(scores.reshape(-1), cells, self.impact.take(postings) * np.repeat(weights[t].astype(np.float32), size[t]))
            t, q = own[by_row], of[by_row]
            numbers = _ranges(row[t], rows[t])
            ends = np.append(0, np.cumsum(np.bincount(q, rows[t], n).astype(np.int64)))
            for i in range(n):
                about, mine = scores[i], numbers[ends[i] : ends[i + 1]]
                if len(mine):
                    about = np.bincount(row_docs.take(mine, 0).reshape(-1), row_scores.take(mine, 0).reshape(-1), self.n) + about
                terms = asked.places[bounds[i] : bounds[i + 1]]
                yield self._best(about, place[terms], asked.weights[terms], at, top, least[begin + i])

    def _best(
        self, about: np.ndarray, place: np.ndarray, weights: np.ndarray, at: np.ndarray, top: int, least: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """The best by scores of single precision (``about``), summed again in double precision."""
        # sums of so many positive numbers are exact up to this share
        slack = (len(place) + 16) * 2.0**-24
        floor = (least - _CLOSE) * (1 - slack)
        docs = np.flatnonzero(about >= floor if floor > 0 else about > 0)
        if len(docs) > top:
            about = about[docs]
            docs = docs[about >= (np.partition(about, -top)[-top] * (1 - slack) - _CLOSE) * (1 - slack)]
        if not len(docs):
            return docs, np.empty(0)
        terms = at[place[place >= 0]]
        self.asked[terms & 0xFFFF], self.weight[terms] = True, weights[place >= 0]
        scores = np.empty(len(docs))
        for i, (a, b) in enumerate(zip(self.doc_first[docs].tolist(), self.doc_first[docs + 1].tolist(), strict=True)):
            own = self.doc_terms[a:b]
            hits = np.flatnonzero(self.asked.take(own & 0xFFFF))
            counts = self.doc_counts[a:b].take(hits).astype(float)
            scores[i] = self.weight.take(own.take(hits)) @ (counts * (K1 + 1) / (counts + self.length[docs[i]]))
        self.asked[terms & 0xFFFF], self.weight[terms] = False, 0
        kept = scores >= max(least - _CLOSE, 0)
        if len(docs) > top:
            kept &= scores >= np.partition(scores, -top)[-top] - _CLOSE
        return docs[kept], scores[kept]


def search_block(index: DataFrame, queries: pa.Table, mean_size: float, top: int) -> DataFrame:
    """Best documents of each task's shards (``RESULT_DDL``) for a block of queries, which is broadcast."""
    terms, weights = (queries.column(c).combine_chunks() for c in ("terms", "weights"))
    bounds = np.append(0, np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False)))
    flat = (x.flatten().to_numpy(zero_copy_only=False) for x in (terms, weights))
    wanted = Asked.of(next(flat).view(np.uint64), next(flat), bounds)
    order = alike(wanted)
    names, versions = (queries.column(c).to_numpy()[order] for c in ("query", "version"))
    wanted = wanted.in_order(order)
    asked = index.sparkSession.sparkContext.broadcast((names, versions, wanted.terms, wanted.weights, wanted.places, wanted.bounds))
    del queries, terms, weights, bounds, wanted, order, names, versions

    def search(batches):
        names, versions, *arrays = asked.value
        wanted = Asked(*arrays)
        least, best = np.zeros(len(wanted)), [(np.empty(0), np.empty(0, bool), np.empty(0, np.int64))] * len(wanted)
        shard = None
        for batch in batches:
            for blob in batch.column("postings"):
                del shard
                shard = Shard(blob.as_buffer(), mean_size)
                for q, (docs, scores) in enumerate(shard.search(wanted, top, least)):
                    if not len(docs):
                        continue
                    # what other tasks may tie with, too: the best by score and identifier
                    all_of = zip(best[q], (np.round(scores, DIGITS), ~shard.known[docs], shard.ids[docs]), strict=True)
                    scores, unknown, ids = (np.concatenate(x) for x in all_of)
                    order = np.lexsort((ids, unknown, -scores))[:top]
                    best[q] = scores[order], unknown[order], ids[order]
                    if len(order) == top:
                        least[q] = scores[order[-1]]
        of = np.repeat(np.arange(len(best)), [len(x[0]) for x in best])
        if len(of):
            scores, unknown, ids = (np.concatenate(x) for x in zip(*best, strict=True))
            columns = [pa.array(names[of]), pa.array(versions[of]), pa.array(ids, mask=unknown), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "version", "doc_id", "score"])

    return index.select("postings").mapInArrow(search, RESULT_DDL)


@contextmanager
def _row_by_row(spark: SparkSession):
    """Arrow batches of one row while a job runs: a shard is megabytes, and a task has any number of them."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, "1")
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def search(docs: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """``query``, ``rank``, ``doc_id``, ``score``: for each of ``queries`` (``query``, ``text``) the ``top`` of ``docs`` (``doc_id``, ``text``).

    BM25 over distinct query words, scores rounded to six digits. Ties go by ``doc_id``, null last. Documents without a
    word of the query have no score and no place. A query without words that the documents hold has no row, as has one
    without a text. A null ``query`` is left out. Repeated rows of ``docs`` are documents of their own; repeated queries
    with one text are asked once, those with other texts are ranked apart.
    """
    spark = docs.sparkSession
    index = stored(build_index(docs), "bm25-index")
    totals = index.agg(F.sum("n_docs"), F.sum("n_words")).first()
    n_docs, n_words = totals[0] or 0, totals[1] or 0
    asked = queries.filter("query IS NOT NULL AND text IS NOT NULL")
    asked = stored(weighted_queries(asked, document_frequencies(index), n_docs), "bm25-queries")
    n_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(n_terms / QUERY_TERMS))
    results = scratch(spark, "bm25-results")
    # rows of results are those of tasks, so there are as many tasks as run at once, not as many as shards
    tasks = index.coalesce(spark.sparkContext.defaultParallelism)
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.hash("query"), F.lit(blocks)) == block).toArrow()
        with _row_by_row(spark):
            search_block(tasks, mine, max(n_words / max(n_docs, 1), 1e-9), top).write.mode("append").parquet(results)
    order = Window.partitionBy("query", "version").orderBy(F.col("score").desc(), F.col("doc_id").isNull(), "doc_id")
    merged = spark.read.schema(RESULT_DDL).parquet(results).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return merged.select("query", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op7_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose identifier divides by fifty, as a query of all its words, against all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    queries = docs.filter(F.col("doc_id") % EVERY == 0).select(F.col("doc_id").alias("query"), "text")
    return search(docs, queries)
