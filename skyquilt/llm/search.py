"""Exact top-k search by BM25: an inverted index per shard with block-max WAND, merged on global statistics.

A shard's postings are ordered by term and document and cut where the document block (BLOCK documents) changes;
each cut keeps its largest impact, each list too. A query's lists, one for each of its terms, are taken by their maxima for each posting:
lists whose maxima add up to a small share of the threshold make no pivot by themselves and are set aside. What the others
add is summed for every document; a pivot is a document that reaches the threshold with the block maxima of the lists set aside, and
of these only the cuts in pivots' blocks are read. The threshold is the k-th score so far, at first that of a sample
of all documents; a shard whose list maxima don't reach it together isn't searched.

Terms that are in many of a shard's documents have no postings but a dense column of impacts, as whole texts for queries hold
nearly all of them and a list of them would skip nothing: their sums come from one matrix product for many queries. Bounds and sums are of single precision and widened by SLACK; the documents that remain are
scored exactly, in double precision, from a forward index. Document counts, lengths and frequencies are those of the whole
corpus, so the shards' lists can be merged as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.plans.scratch import Scratch, batches_of

K1, B = 1.2, 0.75
BLOCK = 64
#: Documents of a shard, on average.
SHARD = 10_000
#: Queries of a round, at most on average: what is shipped to a shard at once.
ROUND = 8192
#: Pivots that are scored without the lists set aside at most, and queries whose dense part is worked out together.
RUN, QUERIES = 8, 64
#: A term is dense if it is in this share of a shard's documents; at most so many are.
DENSE, MOST_DENSE = 1 / 16, 256
#: Groups of shards for each core, at most: a round's queries are shipped to each group.
GROUPS = 4
#: One in so many documents is searched first, from twice as many shards on.
SAMPLED = 16
#: Lists are set aside while their maxima add up to this share of the threshold at most.
ASIDE = 0.05
#: By which share a sum in single precision may be wrong, and more.
SLACK = 1e-4
#: Rows that a Python worker is sent at once. Batches are held whole, on both sides, beside what is made of them.
ROWS = 512
#: Terms of a shard whose impacts are worked out together.
PART = 1 << 18
#: Terms that are counted together before they are shuffled.
COUNTED = 2_000_000
_WORD = re.compile(r"\w+")
_DOC = "shard int, query boolean, id long, words long, terms binary, tf binary, keys array<long>, weights array<double>"


def terms_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 64-bit hashes of the words, sorted, and how often each occurs."""
    own = _WORD.findall((text or "").lower())
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own)).astype(np.int64), return_counts=True)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its terms and their counts as bytes; counts are of two bytes, or of four if one needs it. ``salt`` numbers a task's rows."""
    salt = 0
    for batch in batches:
        words, terms, tf = [], [], []
        for text in batch.column(1):
            own, n = terms_of(text.as_py())
            words.append(int(n.sum()))
            terms.append(own.tobytes())
            tf.append(n.astype("<u2" if not len(n) or n.max() < 1 << 16 else "<u4").tobytes())
        salts = np.arange(salt, salt + len(batch), dtype=np.int64)
        salt += len(batch)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(salts), pa.array(words, pa.int64()), pa.array(terms, pa.binary()), pa.array(tf, pa.binary())], ["doc_id", "kind", "salt", "words", "terms", "tf"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each term and in how many texts it is, added up over many of a task's texts."""
    held, size = [], 0

    def out():
        terms, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n.astype(np.int64))], ["term", "df"])

    for batch in batches:
        own = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64)
        held.append(own)
        size += len(own)
        if size > COUNTED:
            yield out()
            held, size = [], 0
    if size:
        yield out()


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(len(batch)):
            terms, n = terms_of(batch.column(1)[at].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0)[at].as_py(), len(terms)), pa.int64()), pa.array(terms), pa.array(n.astype(np.int64))], ["query_id", "term", "qtf"])


def _ranges(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of the ranges that begin at ``begin`` and have ``n`` each."""
    ends = np.cumsum(n)
    return np.repeat(begin - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


class Shard:
    """The inverted index of some documents: their ids and words, how many terms each has, and all terms and counts in a row.

    ``terms`` may be a list of arrays, which is emptied, so that nothing else holds them while the index is built.
    """

    def __init__(self, ids: np.ndarray, words: np.ndarray, sizes: np.ndarray, terms: np.ndarray | list[np.ndarray], counts: np.ndarray, mean: float):
        # What is as long as all terms is dropped as soon as it can be: a worker's memory is that of its shard's building.
        self.ids, n = ids, len(ids)
        if isinstance(terms, list):
            held, terms = terms, np.concatenate(terms)
            held.clear()
        by = np.argsort(terms, kind="stable").astype(np.int32)
        terms = terms[by]
        new = np.concatenate(([True], terms[1:] != terms[:-1]))[: len(terms)]
        self.terms = terms[new]
        del terms
        term = np.cumsum(new, dtype=np.int32) - np.int32(1)
        # The forward index: each document's terms, by their number, and counts, of which impacts are made when they are asked for.
        self.held, self.begin = np.empty(len(by), np.int32), np.append(0, np.cumsum(sizes))
        self.held[by] = term
        where = np.repeat(np.arange(n, dtype=np.int32), sizes)
        self.counts, self.norm = counts, K1 * (1 - B + B * words / max(mean, 1e-9))
        self.weight = np.zeros(len(self.terms))
        self.blocks = max(1, -(-n // BLOCK))
        df = np.bincount(term, minlength=len(self.terms))
        often = np.argsort(-df, kind="stable")[:MOST_DENSE]
        often = often[df[often] >= max(2, DENSE * n)]
        self.column = np.full(len(self.terms), -1, np.int16)
        self.column[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), self.blocks * BLOCK), np.float32)
        full = np.empty(len(term), bool)
        for a in range(0, len(term), PART):
            at = self.column[term[a : a + PART]]
            full[a : a + PART] = at >= 0
            place = by[a : a + PART][at >= 0]
            self.dense[at[at >= 0], where[place]] = self._exact(place, where[place])
        # The postings of the other terms, by term and document.
        rest, term = by[~full], term[~full]
        del by, full
        self.doc, self.impact = where[rest], np.empty(len(rest), np.float32)
        del where
        for a in range(0, len(rest), PART):
            self.impact[a : a + PART] = self._exact(rest[a : a + PART], self.doc[a : a + PART])
        del rest
        block = (self.doc // np.int32(BLOCK)).astype(np.uint16 if self.blocks < 1 << 16 else np.int32)
        cut = np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])))[: len(term)]
        self.block = block[cut]
        del block
        # Numbers of one kind, as others would be copied to be searched.
        self.first = np.searchsorted(term[cut], np.arange(len(self.terms) + 1, dtype=np.int32))
        del term
        self.cut = np.append(np.flatnonzero(cut), len(cut)).astype(np.int32)
        del cut
        self.top = np.maximum.reduceat(self.impact, self.cut[:-1]) if len(self.impact) else np.empty(0, np.float32)
        # Each term's largest impact, and how long its list is.
        self.most, self.length = np.zeros(len(self.terms), np.float32), np.diff(self.cut[self.first])
        some = self.length > 0
        if some.any():
            self.most[some] = np.maximum.reduceat(self.top, self.first[:-1][some])
        self.most[often] = self.dense.max(1, initial=0)

    def _exact(self, place: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The impacts of the terms at these places of the forward index, which are those of ``doc``."""
        tf = self.counts[place].astype(float)
        return tf * ((K1 + 1) / (tf + self.norm[doc]))

    def search(self, queries: list[tuple[int, np.ndarray, np.ndarray] | tuple[int, np.ndarray, np.ndarray, float]], k: int) -> list[tuple[int, int, float]]:
        """(query, document, score) of the k best documents but the query's own for each (query, terms, weights), best first, ties by id.

        Only documents that share a term are found, and of a query with a fourth value only those that don't score less.
        """
        if not queries or not len(self.terms):
            return []
        ends = np.cumsum([len(x[1]) for x in queries])
        terms, weights = (np.concatenate([x[c] for x in queries]) for c in (1, 2))
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        has = self.terms[at] == terms
        # No document scores more than all lists' maxima together: mostly, a shard of other documents ends here.
        most = np.append(0, np.cumsum(np.where(has, weights * self.most[at], 0)))[np.append(0, ends)]
        own = []
        for i, query in enumerate(queries):
            least, a, b = query[3] if len(query) > 3 else 0.0, ends[i] - len(query[1]), ends[i]
            if (reach := most[i + 1] - most[i]) > 0 and reach * (1 + SLACK) >= least:
                own.append((query[0], at[a:b][has[a:b]], weights[a:b][has[a:b]], least))
        out = []
        for (query, at, weights, least), partial in zip(own, self._dense_parts(own), strict=True):
            docs = self._candidates(query, at, weights, partial, k, least)
            scores = np.round(self._scores(docs, at, weights), 9)  # what differs by less is a tie
            top = np.lexsort((self.ids[docs], -scores))[:k]
            out += [(query, int(self.ids[docs[i]]), float(scores[i])) for i in top if scores[i] > 0 and scores[i] >= least * (1 - SLACK)]
        return out

    def _dense_parts(self, own: list[tuple[int, np.ndarray, np.ndarray, float]]) -> list[np.ndarray]:
        """Every document's score by the dense terms for each query: from one product, or from its few columns alone."""
        columns = [self.column[at] for _, at, _, _ in own]
        many = [i for i, c in enumerate(columns) if (c >= 0).sum() > len(self.dense) / 16]
        table = np.zeros((len(many), len(self.dense)), np.float32)
        for row, i in zip(table, many, strict=True):
            row[columns[i][columns[i] >= 0]] = own[i][2][columns[i] >= 0]
        parts = dict(zip(many, table @ self.dense, strict=True))
        return [parts[i] if i in parts else own[i][2][c >= 0].astype(np.float32) @ self.dense[c[c >= 0]] for i, c in enumerate(columns)]

    def _scores(self, docs: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The exact scores of documents, each summed in the order of its terms, so that equal texts have equal scores."""
        if not len(docs):
            return np.empty(0)
        self.weight[at] = weights
        n = self.begin[docs + 1] - self.begin[docs]
        place = _ranges(self.begin[docs], n)
        weight = self.weight[self.held[place]]
        self.weight[at] = 0
        shared = np.flatnonzero(weight)
        row = np.repeat(np.arange(len(docs)), n)[shared]
        return np.bincount(row, weight[shared] * self._exact(place[shared], docs[row]), len(docs))

    def _candidates(self, query: int, at: np.ndarray, weights: np.ndarray, partial: np.ndarray, k: int, least: float) -> np.ndarray:
        """Documents among which the k best are that score ``least``; ``partial``: every document's score by the dense terms."""
        listed = self.column[at] < 0
        at, weights = at[listed], weights[listed]
        most, n = weights * self.most[at], self.length[at]
        # Short lists of large maxima first: what the last ones add is bounded by few cuts, and reading them costs most.
        way = np.argsort(-most / n)
        rest = np.append(np.cumsum(most[way][::-1])[::-1], 0)  # all that the lists from here on can add

        def read(lists: np.ndarray) -> np.ndarray:
            place = _ranges(self.cut[self.first[at[lists]]], n[lists])
            return np.bincount(self.doc[place], np.repeat(weights[lists], n[lists]) * self.impact[place], len(partial))

        def kth(score: np.ndarray) -> float:
            """The k-th best of the documents but the query's own, as far as they are scored."""
            score = score[: len(self.ids)][self.ids != query]
            return float(np.partition(score, len(score) - k)[-k]) * (1 - 2 * SLACK) if len(score) >= k else 0.0

        begun, score = 0, partial
        if least <= 0:
            begun = min(int(np.searchsorted(-rest, -rest[0] / 2, "right")), len(way))
            score = score + read(way[:begun])
            least = kth(score)
        last = max(begun, int(np.searchsorted(-rest, -ASIDE * least)))
        if last > begun:
            score = score + read(way[begun:last])
        if last == len(way):
            least = max(least, kth(score))
            pivots = np.flatnonzero(score * (1 + SLACK) >= max(least * (1 - SLACK), 1e-30))
        else:
            # Of the lists set aside no pivot comes: their cuts bound what they add in a block.
            own, weight = at[way[last:]], weights[way[last:]]
            m = self.first[own + 1] - self.first[own]
            cuts, weight = _ranges(self.first[own], m), np.repeat(weight, m)
            block = self.block[cuts]
            bound = score.reshape(self.blocks, BLOCK) + np.bincount(block, weight * self.top[cuts], self.blocks)[:, None]
            pivots = np.flatnonzero(bound * (1 + SLACK) >= max(least * (1 - SLACK), 1e-30))
            if len(pivots) > RUN:
                # Postings of the pivots' blocks cost less than the exact scores of so many documents.
                holds = np.zeros(self.blocks, bool)
                holds[pivots // BLOCK] = True
                holds = holds[block]
                cuts, weight = cuts[holds], weight[holds]
                n = self.cut[cuts + 1] - self.cut[cuts]
                place = _ranges(self.cut[cuts], n)
                score = score + np.bincount(self.doc[place], np.repeat(weight, n) * self.impact[place], len(partial))
                least = max(least, kth(score))
                pivots = pivots[score[pivots] * (1 + SLACK) >= least * (1 - SLACK)]
        pivots = pivots[pivots < len(self.ids)]
        return pivots[self.ids[pivots] != query]


def _flat(column: pa.BinaryArray, kind) -> np.ndarray:
    """The numbers in all of a column's bytes, which has no nulls, in a row."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind) if ends[-1] > ends[0] else np.empty(0, kind)


def _lengths(column: pa.BinaryArray) -> np.ndarray:
    return np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1])


def _search(mean: float, k: int, groups: int = 1):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of _DOC, by group (the shard's number modulo ``groups``), a group's queries together and its shards one after another."""
        group, shard, held, asked = None, None, [], []

        def build() -> Shard:
            ids, words = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in (2, 3))
            sizes = np.concatenate([_lengths(x.column(4)) for x in held]) // 8
            wide = np.concatenate([_lengths(x.column(5)) for x in held]) == 4 * sizes
            if wide[sizes > 0].any():
                counts = np.concatenate([np.frombuffer(y, "<u4" if w and len(y) else "<u2").astype(np.uint32) for y, w in zip((y for x in held for y in x.column(5).to_pylist()), wide, strict=True)])
            else:
                counts = np.concatenate([_flat(x.column(5), "<u2") for x in held])
            terms = [_flat(x.column(4), np.int64) for x in held]
            held.clear()
            return Shard(ids, words, sizes, terms, counts, mean)

        def searched() -> pa.RecordBatch:
            out = []
            if held and asked:
                index = build()
                for at in range(0, len(asked), QUERIES):
                    out += index.search(asked[at : at + QUERIES], k)
            held.clear()
            columns = [pa.array([x[c] for x in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))]
            return pa.RecordBatch.from_arrays(columns, ["query_id", "doc_id", "score"])

        for batch in batches:
            if not len(batch):
                continue
            own = [batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1)]
            cuts = np.flatnonzero((own[0][1:] != own[0][:-1]) | (own[1][1:] != own[1][:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                query = own[1][a]
                if held and (own[0][a] % groups != group or (not query and own[0][a] != shard)):
                    yield searched()
                if own[0][a] % groups != group:
                    group, asked = own[0][a] % groups, []
                part = batch.slice(a, b - a)
                if not query:
                    shard = own[0][a]
                    held.append(part)
                    continue
                for i in range(len(part)):
                    keys, weights = (part.column(c)[i].values.to_numpy() for c in (6, 7))
                    # A weight more than keys is the score that a document needs.
                    asked.append((part.column(2)[i].as_py(), keys, weights[: len(keys)], float(weights[-1]) if len(weights) > len(keys) else 0.0))
        if held:
            yield searched()

    return run


def top_k(documents: DataFrame, queries: DataFrame, k: int = 10, kind: str | None = None) -> DataFrame:
    """query_id, rank (from 1), doc_id and score: the k documents that score best for each query's whole text.

    ``documents`` and ``queries`` have doc_id and text. Documents with a query's doc_id are left out; ties go to the
    smaller doc_id. Rows without a doc_id take no part, texts without words find nothing and aren't found,
    fewer than k documents that share a word give fewer rows. ``kind`` names a column, such as the language, by which
    documents share words: shards hold one kind each where it has enough, which changes the time alone. Rows that repeat a doc_id are documents of their own; as
    a query such a doc_id stands for its smallest text.

    Texts become terms and counts once. Each query's terms go to every shard, in rounds of about ROUND queries: what lies in a
    shuffle at once grows with the number of shards, not with that times the number of queries. A round's queries go to groups of
    shards, which are searched one after another. Each round builds the shards anew. Where there are many shards, a round first
    searches a sample of the documents: what the k-th of it scores, the k best of all score at least.
    """
    with batches_of(documents.sparkSession, ROWS):
        return _top_k(documents, queries, k, kind)


def _sharded(docs: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The documents with their shard, and how many shards there are: each kind of SHARD documents or more has its own, the others share some."""
    large = [(r["kind"], r["count"]) for r in docs.where("kind is not null").groupBy("kind").count().where(F.col("count") >= SHARD).orderBy("kind").collect()]
    others = n - sum(c for _, c in large)
    table, shards = [], -(-others // SHARD) if others or not large else 0
    rest, shards = max(1, shards), max(shards, 0 if large else 1)
    for kind, count in large:
        table.append((kind, shards, -(-count // SHARD)))
        shards += table[-1][2]
    hashed = F.xxhash64("doc_id", "salt")
    if not table:
        return docs.withColumn("shard", F.pmod(hashed, F.lit(rest)).cast("int")), shards
    own = docs.sparkSession.createDataFrame(table, "kind string, first int, n int")
    of = F.when(F.col("n").isNull(), F.pmod(hashed, F.lit(rest))).otherwise(F.col("first") + F.pmod(hashed, F.col("n")))
    return docs.join(F.broadcast(own), "kind", "left").withColumn("shard", of.cast("int")), shards


def _top_k(documents: DataFrame, queries: DataFrame, k: int, kind: str | None) -> DataFrame:
    """``top_k``, with all that Python works on run before it returns."""
    spark = documents.sparkSession
    scratch = Scratch(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (F.col(kind) if kind else F.lit(None)).cast("string").alias("kind")).where("doc_id is not null")
    docs = scratch.save(docs.mapInArrow(_tokens, "doc_id long, kind string, salt long, words long, terms binary, tf binary"))
    asked = queries.selectExpr("cast(doc_id as long) as doc_id", "text").where("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("text"))
    wanted = scratch.save(asked.mapInArrow(_query_terms, "query_id long, term long, qtf long"))
    n, words = docs.agg(F.count("*"), F.coalesce(F.sum("words"), F.lit(0))).first()
    df = docs.select("terms").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = df.join(wanted.select("term").distinct(), "term", "left_semi")
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = wanted.join(df.select("term", idf.alias("idf")), "term").groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", (F.col("qtf") * F.col("idf")).alias("w")))).alias("t"))
    weighed = scratch.save(weighed.select("query_id", F.col("t.term").alias("keys"), F.col("t.w").alias("weights")))
    placed, shards = _sharded(docs, n)
    no, none = F.lit(False).alias("query"), lambda kind, name: F.lit(None).cast(kind).alias(name)
    rows = placed.select("shard", no, F.col("doc_id").alias("id"), "words", "terms", "tf", none("array<long>", "keys"), none("array<double>", "weights"))
    rounds = max(1, -(-weighed.count() // ROUND))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")

    def searched(rows: DataFrame, shards: int, own: DataFrame) -> DataFrame:
        groups = -(-shards // -(-shards // (GROUPS * spark.sparkContext.defaultParallelism)))  # of equally many shards
        each = own.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("shard"), F.lit(True).alias("query"), F.col("query_id").alias("id"), none("long", "words"), none("binary", "terms"), none("binary", "tf"), "keys", "weights")
        group = F.col("shard") % groups
        # Each group is a partition of its own: its queries first, then its shards.
        dealt = rows.unionByName(each).repartitionById(groups, group).sortWithinPartitions(group, F.desc("query"), "shard")
        return dealt.mapInArrow(_search(words / max(n, 1), k, groups), "query_id long, doc_id long, score double")

    def floors(own: DataFrame) -> DataFrame:
        """The queries, with the k-th best score of the sample as one more weight where it has as many."""
        some = rows.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(SAMPLED)) == 0).withColumn("shard", F.floor(F.col("shard") / SAMPLED).cast("int"))
        scores = searched(some, -(-shards // SAMPLED), own).groupBy("query_id").agg(F.sort_array(F.collect_list("score"), False).alias("s"))
        least = scores.where(F.size("s") >= k).select("query_id", F.col("s")[k - 1].alias("least"))
        return scratch.save(own.join(least, "query_id", "left").select("query_id", "keys", F.when(F.col("least").isNull(), F.col("weights")).otherwise(F.concat("weights", F.array("least"))).alias("weights")))

    def found(own: DataFrame) -> DataFrame:
        best = searched(rows, shards, floors(own) if shards >= 2 * SAMPLED else own)
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "doc_id", "score")

    # Written one by one, so that a round's shuffle goes before the next one's comes.
    parts = [scratch.save(found(weighed.where(F.pmod(F.xxhash64("query_id"), F.lit(rounds)) == at))) for at in range(rounds)]
    return reduce(DataFrame.unionByName, parts)


#: DuckDB: every document that shares a word with a query is scored. Scores that agree to nine places are ties.
ORACLE = f"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+')) AS t FROM documents WHERE doc_id IS NOT NULL),
f AS (SELECT doc_id, t, count(*)::DOUBLE AS tf FROM d GROUP BY doc_id, t),
l AS (SELECT doc_id, sum(tf) AS n FROM f GROUP BY doc_id),
g AS (SELECT count(*)::DOUBLE AS n, (SELECT sum(n) FROM l) / count(*) AS mean FROM documents WHERE doc_id IS NOT NULL),
i AS (SELECT t, ln(1 + (g.n - count(*) + 0.5e0) / (count(*) + 0.5e0)) AS idf FROM f, g GROUP BY t, g.n),
s AS (SELECT q.doc_id AS query_id, f.doc_id, sum(q.tf * idf * f.tf * {K1 + 1}e0 / (f.tf + {K1}e0 * ({1 - B}e0 + {B}e0 * l.n / g.mean))) AS score
      FROM f q JOIN i USING (t) JOIN f ON f.t = q.t AND f.doc_id <> q.doc_id JOIN l ON l.doc_id = f.doc_id, g WHERE q.doc_id % 100 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT query_id, rank::INTEGER AS rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10
"""
