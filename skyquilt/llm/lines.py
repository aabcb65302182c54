"""Fuzzy line deduplication in DataFrame functions only.

A line's distinct character shingles are hashed and sorted: a random order that is the same for every line. Its signature
is what comes first in that order, and its bands are runs of ROWS neighbours in it: of the first PLACES runs the BANDS
with the smallest hashes, which picks the same runs in two lines that have them both. In lines of at most PLACES shingles
the order is a circle. Two lines of a Jaccard of 0.8 have four common shingles for each other one, so that some run of
four is whole in both: lines of at most BANDS shingles are never missed.

Lines that share a band's key are a bucket. First each line is compared with its buckets' smallest lines (a star);
confirmed links are contracted. In buckets that are left with several components, lines of different components are then
compared inside the join, a bucket being cut into blocks of bounded size: what a join gives are links, not pairs. Every
pair that shares a bucket is so either in one component or compared by the exact Jaccard of all its shingles. Components
are found by distributed union-find, and the first line of each, by doc_id and line number, is kept.

Of pairs at a Jaccard of exactly 0.8 a simulation finds a bucket for all at 10, 20 and 40 shingles together, for 99.9 % at 100 and
99.6 % at 400, and for all of 1500 at 0.85.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyquilt.operators.components import connected_components
from skyquilt.plans.scratch import Scratch

WIDTH = 9
ROWS, PLACES, BANDS = 4, 32, 16
#: Shingles that the runs of a long line take.
TAKE = PLACES + ROWS - 1
PER_CENT = 80
#: Numbers of a sketch.
SKETCH = 8
#: Lines of a block, on average: two blocks are compared by one task.
BLOCK = 256
#: Rows of a few numbers that are broadcast at most; more are shuffled. It is low, so that all but small tables go the same way.
BROADCAST_ROWS = 1 << 15


def _let(value: Column, then) -> Column:
    """``then`` of a value that is worked out once: a lambda's variable, as Spark repeats what is written twice."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def shingles(line: Column) -> Column:
    """The hashed character shingles of a line, repeated as they are; the whole line, if it is shorter than WIDTH.

    A shingle is hashed as UTF-16. Lines of two bytes a character are cut there, so that a place in the line is a place in
    the bytes; others are cut in four bytes a character, and each shingle is turned to UTF-16.
    """

    def cut(size: int, hashed):
        def of(units: Column) -> Column:
            places = F.sequence(F.lit(1), F.greatest(F.length(units) - (size * WIDTH - 1), F.lit(1)), F.lit(size))
            return F.transform(places, lambda p: F.xxhash64(hashed(F.substr(units, p, F.lit(size * WIDTH)))))

        return of

    # A decoder swallows one mark of byte order, so it is given one.
    again = lambda x: F.encode(F.decode(F.concat(F.lit(b"\0\0\xfe\xff"), x), "UTF-32"), "UTF-16BE")
    wide = _let(F.encode(line, "UTF-32"), cut(4, again))
    return _let(F.encode(line, "UTF-16BE"), lambda u: F.when(F.length(u) == 2 * F.length(line), cut(2, lambda x: x)(u)).otherwise(wide))


def with_keys(lines: DataFrame, norm: str = "norm") -> DataFrame:
    """``lines`` with band_keys, an array of at most BANDS keys, instead of ``norm``.

    Arrays are sorted and made distinct in columns of their own, where Spark compiles it, and not in lambdas.
    """
    rest = [c for c in lines.columns if c != norm]
    x = lines.select(*rest, F.sort_array(shingles(F.col(norm))).alias("_s"))
    x = x.select("*", F.array_distinct(F.slice("_s", 1, 2 * TAKE)).alias("_d"))
    # The first of a long line's shingles are enough, unless they repeat.
    whole = (F.size("_d") >= TAKE) | (F.size("_s") <= 2 * TAKE)
    x = x.select(*rest, F.when(whole, F.col("_d")).otherwise(F.array_distinct("_s")).alias("_d"))
    ring = F.when(F.size("_d") >= TAKE, F.slice("_d", 1, TAKE)).otherwise(F.concat("_d", F.slice("_d", 1, ROWS - 1)))
    x = x.select(*rest, F.least(F.size("_d"), F.lit(PLACES)).alias("_n"), ring.alias("_r"))
    # Its elements one by one, as a slice in a lambda copies the whole array.
    run = lambda r: lambda i: F.xxhash64(*(F.get(r, i + k) for k in range(ROWS)))
    runs = _let(F.col("_r"), lambda r: F.transform(F.sequence(F.lit(0), F.col("_n") - 1), run(r)))
    return x.select(*rest, F.slice(F.sort_array(runs), 1, BANDS).alias("band_keys"))


def split_lines(documents: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the whole text), line_no (from 0), norm (trimmed and lower-cased) and node of every line.

    ``node`` is the hash of norm, and null for lines that take no part: blank ones and those without a doc_id.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text").where("text is not null")
    rows = rows.select("doc_id", "row", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    rows = rows.select("doc_id", "row", "line_no", F.lower(F.trim("line")).alias("norm"))
    return rows.withColumn("node", F.when((F.col("norm") != "") & F.col("doc_id").isNotNull(), F.xxhash64("norm")))


def _small(table: DataFrame) -> DataFrame:
    """``table``, a written one of a few numbers in each row and unique keys, to be joined without a sort of the other side.

    It is broadcast if it has at most BROADCAST_ROWS rows; else each task holds its share of it, however hot a key is.
    """
    return table.hint("broadcast" if table.count() <= BROADCAST_ROWS else "shuffle_hash")


def _similar(both: Column, n: str, m: str) -> Column:
    return 100 * both >= PER_CENT * (F.col(n) + F.col(m) - both)


def _near(n: str, m: str) -> Column:
    """No Jaccard is above the ratio of two sets' sizes."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * PER_CENT


def sketches(texts: DataFrame) -> DataFrame:
    """node, n (how many shingles) and a sketch of the set of shingles: SKETCH numbers of 64 bits, a shingle turning one of them all over.

    As bits are turned over, not set, what two sets have in common cancels out, and a long line's sketch doesn't fill up.
    """
    each = texts.select("node", F.explode(F.array_distinct(shingles(F.col("norm")))).alias("h"))
    bit = lambda k: F.expr(f"bit_xor(if(shiftrightunsigned(h, 6) % {SKETCH} = {k}, shiftleft(1L, cast(h & 63 as int)), 0L))").alias(f"s{k}")
    return each.groupBy("node").agg(F.count("*").cast("int").alias("n"), *(bit(k) for k in range(SKETCH)))


def _close(x: str, y: str) -> Column:
    """Whether two sets may be similar by their sizes and sketches; it is never false for sets that are.

    Each bit in which sketches differ is a shingle, or an odd number of them, that only one set has; similar sets have few.
    """
    differ = sum((F.bit_count(F.col(f"s{k}_{x}").bitwiseXOR(F.col(f"s{k}_{y}"))) for k in range(1, SKETCH)), F.bit_count(F.col(f"s0_{x}").bitwiseXOR(F.col(f"s0_{y}"))))
    return _near(f"n_{x}", f"n_{y}") & (differ * (100 + PER_CENT) <= (F.col(f"n_{x}") + F.col(f"n_{y}")) * (100 - PER_CENT))


def _alike() -> Column:
    """The exact comparison of norm_x and norm_y, whose shingles are only made where it is asked for."""
    both = F.size(F.array_intersect(shingles(F.col("norm_x")), shingles(F.col("norm_y"))))
    return _let(both, lambda k: _similar(k, "n_x", "n_y"))


def confirmed(pairs: DataFrame, texts: DataFrame, sketch: DataFrame) -> DataFrame:
    """Of the pairs (a, b) of nodes those whose shingle sets have a Jaccard of PER_CENT at least; ``texts``: node, norm.

    Texts travel for pairs whose sketches are close, as they are an eighth of their shingles, which are made where a pair meets.
    """
    x, y = (sketch.select(F.col("node").alias(end), *(F.col(c).alias(f"{c}_{side}") for c in sketch.columns[1:])) for end, side in (("a", "x"), ("b", "y")))
    near = pairs.join(x, "a").join(y, "b").where(_close("x", "y")).select("a", "b", "n_x", "n_y")
    x, y = (texts.select(F.col("node").alias(end), F.col("norm").alias(f"norm_{side}")) for end, side in (("a", "x"), ("b", "y")))
    return near.join(x, "a").join(y, "b").where(_alike()).select("a", "b")


def _across(open_: DataFrame, texts: DataFrame, sketch: DataFrame) -> DataFrame:
    """Links (a, b) between lines of one bucket and different components; ``open_``: key, node, c and c0.

    A pair is compared in the smallest of the keys that it shares. A bucket's lines are dealt to blocks of about BLOCK,
    and each two blocks meet once. Lines outside the bucket's largest component c0 are first asked whether they are like any line
    of it, which gives a row for each line and block, not for each pair; then they are compared among themselves.
    """
    blocks = open_.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("m"))
    keys = open_.groupBy("node").agg(F.collect_set("key").alias("keys"))  # at most BANDS
    rows = open_.join(blocks, "key").join(keys.join(texts, "node").join(sketch, "node"), "node")
    rows = rows.withColumn("i", F.pmod(F.xxhash64("node"), F.col("m")).cast("int"))
    two = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda j: F.struct(F.least("i", j).alias("lo"), F.greatest("i", j).alias("hi")))
    rows = rows.select("key", F.inline(two), "i", "node", "c", "c0", "keys", "norm", *sketch.columns[1:])
    side = lambda rows, end: rows.repartition("key", "lo", "hi").select("key", "lo", "hi", *(F.col(c).alias(f"{c}_{end}") for c in rows.columns[3:])).alias(end)
    same = F.expr("x.key = y.key and x.lo = y.lo and x.hi = y.hi")
    first = F.array_min(F.array_intersect("keys_x", "keys_y")) == F.col("x.key")
    alike = _close("x", "y") & first & _alike()
    out, within = rows.where("c <> c0"), rows.where("c = c0")
    apart = F.expr("x.lo = x.hi or i_x <> i_y")
    joined = side(out, "x").join(side(within, "y"), same & apart & alike, "left_semi").select(F.col("c0_x").alias("p"), F.col("node_x").alias("q"))
    once = F.expr("if(x.lo < x.hi, i_x = x.lo and i_y = x.hi, node_x < node_y)")
    met = side(out, "x").join(side(out, "y"), same & once & (F.col("c_x") != F.col("c_y")) & alike).select(F.col("node_x").alias("p"), F.col("node_y").alias("q"))
    return joined.union(met).select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))


def _components(signed: DataFrame, lines: DataFrame, scratch: Scratch) -> DataFrame:
    """node and component of every line that is linked with another; ``signed``: node, band_keys."""
    rows = signed.select("node", F.explode("band_keys").alias("key"))
    # Counted by key with a partial sum in every task, so that a hot bucket is a row of each.
    shared = rows.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("far")).where("hub <> far").select("key", "hub")
    shared = scratch.save(shared)
    buckets = scratch.save(rows.join(_small(shared), "key").select("key", "node", "hub").distinct())
    wanted = scratch.save(buckets.select("node").distinct())
    found = lines.select("node", "norm").join(_small(wanted), "node", "left_semi").dropDuplicates(["node"])
    texts = scratch.save(found)
    sketch = scratch.save(sketches(texts))
    stars = buckets.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = scratch.save(confirmed(stars, texts, sketch))
    label = connected_components(links)
    held = scratch.save(buckets.select("key", "node").join(label, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c")))
    parts = held.groupBy("key", "c").agg(F.count("*").alias("m"))
    mixed = parts.groupBy("key").agg(F.max_by("c", "m").alias("c0"), F.count("*").alias("parts")).where("parts > 1").select("key", "c0")
    more = scratch.save(_across(scratch.save(held.join(mixed, "key")), texts, sketch))
    scratch.drop(shared, buckets, wanted, texts, sketch, held)
    return connected_components(links.union(more))


def _first_places(places: DataFrame, label: DataFrame, scratch: Scratch) -> DataFrame:
    """node, first_doc and first_line of the nodes whose component has several lines; ``places``: doc_id, line_no, node."""
    per = places.groupBy("node").agg(F.count("*").alias("n"))
    several = per.join(label, "node", "left").where("n > 1 or component is not null")
    several = scratch.save(several.select("node", F.coalesce("component", "node").alias("c")))
    own = places.join(_small(several), "node").groupBy("c", "doc_id").agg(F.min("line_no").alias("first_line"))
    own = scratch.save(own)
    doc = own.groupBy("c").agg(F.min("doc_id").alias("doc_id"))
    first = own.join(doc, ["c", "doc_id"]).withColumnRenamed("doc_id", "first_doc")
    return scratch.save(several.join(first, "c").select("node", "first_doc", "first_line"))


def line_components(documents: DataFrame) -> DataFrame:
    """doc_id, row, line_no and keep for every line of every text; a line whose component has an earlier line isn't kept.

    Lines are compared trimmed and lower-cased. Blank lines are always kept, as are lines without a doc_id,
    which take no part. Lines that are equal are one component, by a hash of 64 bits. Null texts have no
    lines. ``row`` is a hash of the whole text, by which rows that repeat a doc_id are told apart; if the component's
    first doc_id has the line at one number in several rows, it is kept in each of them.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark)
    lines = split_lines(documents)
    signed = scratch.save(with_keys(lines))
    known = signed.where("node is not null")
    label = _components(known.select("node", "band_keys"), lines.where("node is not null"), scratch)
    first = _first_places(known.select("doc_id", "line_no", "node"), label, scratch)
    every = signed.select("doc_id", "row", "line_no", "node").join(_small(first), "node", "left")
    keep = F.col("first_doc").isNull() | ((F.col("doc_id") == F.col("first_doc")) & (F.col("line_no") == F.col("first_line")))
    return every.select("doc_id", "row", "line_no", keep.alias("keep"))


def _unused(names: Iterable[str], name: str) -> str:
    """``name``, longer if a column is called so; Spark's names have no case."""
    taken = {x.lower() for x in names}
    while name in taken:
        name += "_"
    return name


def dedup_lines(documents: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """``documents`` with text and n_chars of what is left, other columns as they are.

    A text whose lines all go keeps its blank lines. Its row stays, unless ``drop_emptied``: then rows that lost a line
    and have none left but blank ones go. Rows that had no line to lose stay in any case.
    """
    names = documents.columns
    doc, row, gone, left = (_unused(names, x) for x in ("_doc", "_row", "_gone", "_left"))
    lost = line_components(documents).where("not keep").groupBy(F.col("doc_id").alias(doc), F.col("row").alias(row)).agg(F.collect_set("line_no").alias(gone))
    same = (documents["doc_id"].cast("long") == lost[doc]) & (F.xxhash64(documents["text"]) == lost[row])
    rows = documents.join(lost, same, "left")
    lines = F.split("text", "\n", -1)
    kept = _let(lines, lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(gone)), lambda i: F.get(x, i)))
    rows = rows.withColumn(left, F.when(F.col(gone).isNotNull(), kept))
    if drop_emptied:
        rows = rows.where(F.col(left).isNull() | F.exists(left, lambda x: F.trim(x) != ""))
    text = F.when(F.col(left).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in names))


def line_report(documents: DataFrame) -> DataFrame:
    """doc_id, line_no and keep of every line, for ``op5_line_dedup``."""
    return line_components(documents).drop("row")


#: DuckDB: links from an inverted index over all shingles of all different lines, then the first line that can be reached.
ORACLE = f"""
WITH RECURSIVE a AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, unnest(range(len(a))) AS line_no, lower(trim(unnest(a), ' ')) AS x FROM a),
u AS (SELECT x, row_number() OVER (ORDER BY x) AS i, greatest(length(x) - {WIDTH - 1}, 1) AS n FROM (SELECT DISTINCT x FROM l WHERE x <> '' AND doc_id IS NOT NULL)),
s AS (SELECT DISTINCT i, substr(x, p::BIGINT, {WIDTH}) AS g FROM (SELECT i, x, unnest(range(1, n + 1)) AS p FROM u)),
z AS (SELECT i, count(*) AS n FROM s GROUP BY i),
p AS (SELECT a.i AS x, b.i AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.i <> b.i GROUP BY 1, 2),
k AS (SELECT x, y FROM p JOIN z a ON a.i = x JOIN z b ON b.i = y WHERE 100 * c >= {PER_CENT} * (a.n + b.n - c)),
r AS (SELECT i AS x, i AS y FROM u UNION SELECT r.x, k.y FROM r JOIN k ON r.y = k.x),
c AS (SELECT x AS i, min(y) AS component FROM r GROUP BY x),
f AS (SELECT doc_id, line_no, component FROM l JOIN u USING (x) JOIN c USING (i) WHERE doc_id IS NOT NULL),
o AS (SELECT component, min((doc_id, line_no)) AS first FROM f GROUP BY component)
SELECT l.doc_id, l.line_no::INTEGER AS line_no, component IS NULL OR (f.doc_id, f.line_no) = first AS keep
FROM l LEFT JOIN f ON f.doc_id = l.doc_id AND f.line_no = l.line_no LEFT JOIN o USING (component)
"""
