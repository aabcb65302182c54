"""Near-duplicate documents: one-permutation MinHash with optimal densification, banded buckets and star edges.

1. A document's distinct word shingles are hashed to 64 bits. The top of a hash chooses one of ROWS * BANDS
   bins, the smallest hash of each bin is its value, and an empty bin takes the value of the first occupied
   bin on a random walk of its own (optimal densification). ROWS bins make a band's key.
2. Documents with the same set are one class, for which the smallest doc_id stands.
3. Documents that share a band's key form a bucket. A bucket of k documents gives k - 1 candidate edges, a
   star; a bucket's documents meet in two steps, per batch and then across batches, so that a hot key arrives
   as one row per batch. Components of the candidate edges are clusters: two documents that share any bucket
   are in one cluster.
4. Inside a cluster links are confirmed on the full sets, whatever the star looked like, so that a link
   between two documents that are both unlike their hub isn't lost. A cluster of more than BLOCK shingles is
   cut into blocks, and each pair of blocks is a task of its own.
5. Components of the confirmed links are the result.

Two documents with a similarity of 0.85 share no bucket with probability 2e-7, with one of 0.8 with 8e-5, more
similar ones less often.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.operators.components import connected_components
from skyquilt.plans.scratch import Scratch

ROWS, BANDS = 7, 40
BINS = ROWS * BANDS
#: Shingles in a block of a cluster.
BLOCK = 500_000
#: Documents whose bands meet before the shuffle.
SLICE = 2_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], dtype=np.uint64)
#: The random walk of each bin. With one occupied bin, it isn't met in a hundredth of the walks.
_WALK = np.random.default_rng(7).integers(0, BINS, (BINS, 1300))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of the whole sequence, if it is shorter than ``width``."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and the six ASCII spaces
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    rolled = hashed[:n] * _ODD[0]
    for k in range(1, width):
        rolled = mix(rolled) + hashed[k : k + n] * _ODD[k % len(_ODD)]
    rolled = np.sort(mix(rolled))
    return rolled[np.concatenate(([True], rolled[1:] != rolled[:-1]))]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The BINS values of a set that isn't empty."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    own = np.full(BINS, -1, np.int64)
    own[bins[first]] = first
    empty = np.flatnonzero(own < 0)
    if len(empty):
        taken, left = own >= 0, empty
        for near in (slice(0, 12), slice(12, 150), slice(150, None)):
            steps = _WALK[left, near]
            hit = taken[steps]
            at = hit.argmax(1)
            to = steps[np.arange(len(left)), at]
            good = hit[np.arange(len(left)), at]
            own[left[good]] = own[to[good]]
            left = left[~good]
            if not len(left):
                break
        own[left] = first[0]  # a walk that met no occupied bin
    return shingles[own]


def band_keys(values: np.ndarray) -> np.ndarray:
    """The BANDS keys of a signature; a key is different in each band."""
    rows = values.reshape(BANDS, ROWS)
    out = np.arange(BANDS, dtype=np.uint64) * _ODD[0]
    for k in range(ROWS):
        out = mix(out + rows[:, k] * _ODD[1])
    return out


def sketch(documents: DataFrame, width: int) -> DataFrame:
    """doc_id, row (a hash of the text), n_shingles, print (of the whole set) and keys (BANDS 64-bit words, null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, prints, keys = [], [], []
            for text in batch.column(1):
                own = shingle_set(text.as_py(), width)
                n.append(len(own))
                prints.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                keys.append(band_keys(signature(own)).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.binary())], ["doc_id", "row", "n_shingles", "print", "keys"])

    return documents.selectExpr("cast(doc_id as long) as doc_id", "text", "xxhash64(text) as row").mapInArrow(run, "doc_id long, row long, n_shingles long, print binary, keys binary")


def _batch_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the documents that share a key inside a slice: the key with the smallest (kind 0), and the edges of the star to it."""
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            part = batch.slice(at, SLICE)
            docs = np.repeat(part.column(0).to_numpy(zero_copy_only=False), BANDS)
            keys = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int64)
            order = np.lexsort((docs, keys))
            docs, keys = docs[order], keys[order]
            first = np.concatenate(([True], keys[1:] != keys[:-1]))
            hubs = docs[np.flatnonzero(first)[np.cumsum(first) - 1]]
            edges = np.unique(np.stack([hubs[~first], docs[~first]], 1), axis=0) if (~first).any() else np.empty((0, 2), np.int64)
            a, b = np.concatenate([keys[first], edges[:, 0]]), np.concatenate([docs[first], edges[:, 1]])
            kind = np.repeat([False, True], [first.sum(), len(edges)])
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["edge", "a", "b"])


def _links(sets: list[np.ndarray], per_cent: int) -> list[tuple[int, int]]:
    """A spanning forest of the graph that links sets with 100 * intersection >= per_cent * union.

    One set's row of the graph is counted through an inverted index. The rows of sets that were linked to the
    first tree directly needn't be counted, once every other set's row is: a link between two trees has an
    end outside the first.
    """
    sizes = np.array(list(map(len, sets)))
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    first = np.concatenate(([True], tokens[1:] != tokens[:-1]))
    begin = np.flatnonzero(first)
    length = np.diff(np.append(begin, len(tokens)))
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(first) - 1
    ends = np.cumsum(sizes)

    def row(x: int) -> np.ndarray:
        own = place[ends[x] - sizes[x] : ends[x]]
        n = length[own]
        at = np.repeat(begin[own] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        return np.flatnonzero(100 * both >= per_cent * (sizes + sizes[x] - both))

    up = list(range(len(sets)))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []

    def expand(x: int) -> None:
        for y in row(x).tolist():
            if (a := top(x)) != (b := top(y)):
                up[max(a, b)] = min(a, b)
                out.append((x, y))

    done: set[int] = set()
    # A few rows from the sets that share most shingles with others, to grow the first tree.
    shared = np.add.reduceat((length[place] > 1).astype(np.int64), ends - sizes)
    for x in np.argsort(-shared, kind="stable")[: 1 + len(sets) // 50].tolist():
        done.add(x)
        expand(x)
    roots = [top(x) for x in range(len(sets))]
    main = Counter(roots).most_common(1)[0][0]
    for x in range(len(sets)):
        if roots[x] != main and x not in done:
            expand(x)
    return out


def _confirm(width: int, per_cent: int):
    """Rows (task, node, print, text), sorted by task, to links (a, b) between nodes."""

    def flush(rows: list) -> Iterator[tuple[int, int]]:
        own = {}
        for node, told, text in rows:
            if node not in own:
                found = shingle_set(text, width)
                if xxhash.xxh3_128_digest(found.tobytes()) == told:  # else another row with the same doc_id
                    own[node] = found
        if len(own) > 1:
            nodes = list(own)
            for x, y in _links(list(own.values()), per_cent):
                yield nodes[x], nodes[y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, task = [], None
        pack = lambda x: pa.RecordBatch.from_arrays([pa.array([e[k] for e in x], pa.int64()) for k in (0, 1)], ["a", "b"])
        for batch in batches:
            out = []
            for now, *row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if now != task:
                    out += flush(rows)
                    rows, task = [], now
                rows.append(row)
            yield pack(out)
        yield pack(list(flush(rows)))

    return run


def _classes(sets: DataFrame, scratch: Scratch) -> tuple[DataFrame, bool]:
    """print, rep (the smallest doc_id), n and node of each distinct set, and whether some node isn't its rep.

    It is, unless a doc_id is repeated with another text and so stands for two sets.
    """
    classes = scratch.save(sets.groupBy("print").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n")))
    twice = scratch.save(classes.groupBy("rep").agg(F.count("*").alias("k")).where("k > 1").select("rep"))
    if twice.isEmpty():
        return classes.withColumn("node", F.col("rep")), False
    node = F.when(F.col("again"), F.xxhash64("print", "rep")).otherwise(F.col("rep"))
    return scratch.save(classes.join(twice.withColumn("again", F.lit(True)), "rep", "left").select("print", "rep", "n", node.alias("node"))), True


def near_duplicate_rows(documents: DataFrame, width: int = 5, per_cent: int = 80) -> DataFrame:
    """What ``near_duplicates`` gives, and row, a hash of the text."""
    spark = documents.sparkSession
    scratch = Scratch(spark)
    rows = scratch.save(sketch(documents, width))
    sets = rows.where("doc_id is not null and print is not null")
    classes, odd = _classes(sets, scratch)
    keyed = sets.join(classes.select("print", F.col("rep").alias("doc_id"), "node"), ["print", "doc_id"]).select("node", "keys")
    stars = scratch.save(keyed.mapInArrow(_batch_stars, "edge boolean, a long, b long"))
    key = Window.partitionBy("a")
    across = stars.where("not edge").withColumn("hub", F.min("b").over(key)).where("hub <> b").select(F.col("hub").alias("a"), "b")
    edges = scratch.save(stars.where("edge").select("a", "b").union(across).distinct())
    clusters = connected_components(edges)
    scratch.drop(stars)
    # A cluster's blocks, by its weight; a pair of blocks is a task.
    member = clusters.join(classes, "node")
    blocks = member.groupBy("component").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("m"))
    member = member.join(blocks, "component").withColumn("i", F.pmod(F.xxhash64("node"), F.col("m")).cast("int"))
    task = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda j: F.struct(F.least("i", j).alias("lo"), F.greatest("i", j).alias("hi")))
    whole = documents.selectExpr("cast(doc_id as long) as rep", "text").where("rep is not null and text is not null")
    whole = member.select("rep", "node", "print", "component", "m", "i").join(whole, "rep")
    whole = whole.select("component", F.explode(task).alias("t"), "node", "print", "text")
    whole = whole.select(F.xxhash64("component", "t.lo", "t.hi").alias("task"), "node", "print", "text")
    links = whole.repartition("task").sortWithinPartitions("task", "node").mapInArrow(_confirm(width, per_cent), "a long, b long")
    found = connected_components(links)
    reps = classes.select("print", "rep", "node").join(found, "node", "left").select("print", "rep", F.coalesce("component", "node").alias("component"))
    if odd:
        smallest = reps.groupBy("component").agg(F.min("rep").alias("smallest"))
        reps = reps.join(smallest, "component").select("print", F.col("smallest").alias("component"))
    out = rows.select("doc_id", "row", "n_shingles", "print").join(reps.select("print", "component"), "print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = out.select("doc_id", "row", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(documents: DataFrame, width: int = 5, per_cent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) for every row of ``documents``.

    Words are what stands between ASCII spaces, A-Z lower-cased; a text of fewer words than ``width`` is one
    shingle. Texts without words, and null ones, have an empty set and are linked with nothing; so are rows
    without a doc_id, whose component_id is null and which are kept. Repeated rows are rows of one component; a
    doc_id that is repeated with another text is a document for each text, and only the texts' likeness links them.
    Other columns are ignored. ``component_id`` is the smallest doc_id that can be reached over links.
    A pair at a similarity of 0.8 shares no bucket with probability 8e-5, one of 0.85 with 2e-7.
    """
    return near_duplicate_rows(documents, width, per_cent).drop("row")


def drop_near_duplicates(documents: DataFrame, width: int = 5, per_cent: int = 80) -> DataFrame:
    """``documents`` without the rows that ``near_duplicates`` doesn't keep; of each group one document stays."""
    gone = near_duplicate_rows(documents, width, per_cent).where("not kept").select("doc_id", "row").distinct().toDF("_doc", "_row")
    same = (documents["doc_id"].cast("long") == gone["_doc"]) & (F.xxhash64(documents["text"]) == gone["_row"])
    return documents.join(gone, same, "left_anti")


#: DuckDB: links from an inverted index over all shingles, then the smallest reachable id.
ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS a FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 3 THEN [array_to_string(a, ' ')]
        ELSE list_transform(range(1, len(a) - 1), lambda i: array_to_string(a[i:i + 2], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
k AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN k ON k.x = d.doc_id
"""
