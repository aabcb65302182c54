"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Reading: the archive is split at each ``WARC/1.1`` line by Spark's own text reader; of a plain archive a task sees
only its byte range, of a gzip one all of it. Each piece is a candidate record; its header names the offset at which its successor
must begin. Runs of candidates that point at one another are contracted inside a block of the file, pointers
between runs are doubled until none moves, and only candidates that are reached from the file's start are
records. A magic line inside a payload isn't reached and goes back into the payload that holds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.plans.scratch import Scratch, tidy

MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
#: A payload shorter than this is always stored whole.
REVISIT_BYTES = 1000
#: Files are cut into blocks of so many bytes for the contraction of runs.
BLOCK_BYTES = 8 << 20
#: Rows of a few numbers that are broadcast at most; more are shuffled.
BROADCAST_ROWS = 1 << 18
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _small(table: DataFrame) -> DataFrame:
    """``table``, a written one of a few numbers in each row, to be broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _header(pairs: list[tuple[str, Column]]) -> Column:
    return F.concat(F.lit(MAGIC), *(F.when(v.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))) for k, v in pairs), F.lit("\r\n"))


def plan_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest, payload_bytes and refers_to, which is null for a response.

    Of records whose payloads are equal and of at least REVISIT_BYTES, those with the largest page_id are
    responses and the others revisit it. A null html is empty, a null page_id never refers or is referred to.
    """
    scratch = Scratch(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha1(F.encode("payload", "UTF-8")), "payload_bytes": F.octet_length("payload").cast("long")})
    long = F.col("payload_bytes") >= REVISIT_BYTES
    last = rows.where(long).groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("last"), F.count("page_id").alias("n")).where("n > 1").drop("n")
    # Payloads needn't be shuffled where few are repeated.
    rows = rows.join(_small(scratch.save(last)), ["payload_digest", "payload_bytes"], "left")
    return rows.withColumn("refers_to", F.when(F.col("page_id") < F.col("last"), F.col("last"))).drop("last")


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Writes what ``plan_records`` gives as one archive per partition. Spaces and control characters of a url are percent-coded.

    Plain archives are read in splits. With ``compression`` gzip they take less room, and one task reads each.
    """
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit(_HTTP)).otherwise(F.concat(F.lit(_HTTP), F.col("payload")))
    head = _header([
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), ("WARC-Record-ID", name), ("WARC-Target-URI", url),
        ("WARC-Date", F.lit("2000-01-01T00:00:00Z")), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))),
        ("X-Payload-Bytes", F.col("payload_bytes").cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", F.octet_length(body).cast("string")),
    ])
    records.select(F.concat(head, body).alias("value")).write.option("lineSep", GAP).text(path, compression=compression)


def _field(name: str) -> Column:
    return F.regexp_extract("head", rf"(?m)^{name}: ([^\r\n]*)", 1)


def read_warc(spark, path: str) -> DataFrame:
    """One row per record of the archives under ``path``: file, head, body. No archives give no rows.

    The archives are read twice by one plan, for where pieces end and then for what is in them, so ``path`` must stay as it is.
    """
    scratch = Scratch(spark)
    cut = spark.read.option("lineSep", MAGIC).text(path)
    here = F.col("_metadata")
    cut = cut.select(here["file_path"].alias("file"), here["file_block_start"].alias("split"), F.monotonically_increasing_id().alias("k"), "value")
    size = F.octet_length("value").cast("long") + len(MAGIC)
    head = F.substring_index("value", GAP, 1)
    length = F.regexp_extract(head, r"(?m)^Content-Length: (\d{1,18})\r?$", 1)
    sized = scratch.save(cut.select("file", "split", "k", size.alias("size"), F.octet_length(head).cast("long").alias("head_bytes"), length.alias("n")))
    # Where a split's first piece begins: the bytes of the splits before it, which are few per file.
    sums = sized.groupBy("file", "split").agg(F.sum("size").alias("bytes"))
    base = sums.select("file", "split", F.coalesce(F.sum("bytes").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    within = Window.partitionBy("file", "split").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    sized = sized.withColumn("end", F.coalesce(F.sum("size").over(within), F.lit(0)))
    # A piece follows the magic line before it, so its record begins len(MAGIC) earlier.
    spot = sized.join(base, ["file", "split"]).select("file", "split", "k", (F.col("base") + F.col("end") - len(MAGIC)).alias("offset"), "head_bytes", "n")
    after = F.col("offset") + len(MAGIC) + F.col("head_bytes") + 2 * len(GAP) + F.expr("try_cast(n as bigint)")
    spot = scratch.save(spot.select("file", "split", "k", "offset", after.alias("next")))
    live = _reached(spot.where("offset >= 0").select("file", "offset", "next"), scratch)
    odd = scratch.save(_owned(spot.select("file", "split", "k", "offset"), live).where("not alone").drop("alone"))
    return _joined(cut, odd)


def _reached(spot: DataFrame, scratch: Scratch) -> DataFrame:
    """The offsets (file, offset) on the chain from each file's offset 0."""
    block = F.floor(F.col("offset") / BLOCK_BYTES)
    order = Window.partitionBy("file", "block").orderBy("offset")
    runs = spot.withColumn("block", block)
    runs = runs.withColumn("starts", F.coalesce(F.lag("next").over(order) != F.col("offset"), F.lit(True)).cast("int"))
    runs = scratch.save(runs.withColumn("run", F.sum("starts").over(order)))
    ends = runs.groupBy("file", "block", "run").agg(F.min("offset").alias("at"), F.max_by("next", "offset").alias("to"))
    # A run is entered at its first offset. One that is entered further in is cut there.
    entered = ends.select("file", F.col("to").alias("offset")).distinct()
    inside = runs.join(entered, ["file", "offset"]).where("starts = 0").select("file", "offset").distinct().withColumn("cut", F.lit(1))
    again = runs.join(inside, ["file", "offset"], "left").withColumn("starts", F.greatest("starts", F.coalesce("cut", F.lit(0))))
    again = scratch.save(again.withColumn("run", F.sum("starts").over(order)).select("file", "block", "run", "offset", "next"))
    jump = scratch.save(again.groupBy("file", "block", "run").agg(F.min("offset").alias("at"), F.max_by("next", "offset").alias("to")).select("file", "at", "to", "block", "run"))
    hops = jump.select("file", "at", "to")
    seen = jump.where("at = 0").select("file", "at")
    known = scratch.save(seen)
    while True:
        # Doubling: what is reached so far takes one hop, then every hop is replaced by two.
        more = scratch.save(known.union(known.join(hops, ["file", "at"]).select("file", F.col("to").alias("at")).join(jump.select("file", "at"), ["file", "at"], "left_semi")).distinct())
        was, now = known.count(), more.count()
        known = more
        if now == was:
            break
        twice = hops.select("file", F.col("at").alias("to"), F.col("to").alias("far"))
        hops = scratch.save(hops.join(twice, ["file", "to"]).select("file", "at", F.col("far").alias("to")))
    good = jump.join(known, ["file", "at"]).select("file", "block", "run")
    return scratch.save(again.join(good, ["file", "block", "run"]).select("file", "offset"))


def _owned(spot: DataFrame, live: DataFrame) -> DataFrame:
    """For each piece the offset of the record that it belongs to (owner), and whether it is that whole record (alone).

    A reached piece is its own owner. An unreached one belongs to the last record that begins before it, in its
    own block or at the end of an earlier one; before a file's first record there is none, and owner is null.
    """
    rows = spot.join(live.withColumn("live", F.lit(True)), ["file", "offset"], "left").withColumn("block", F.floor(F.col("offset") / BLOCK_BYTES))
    near = Window.partitionBy("file", "block").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("at", F.last(F.when(F.col("live"), F.col("offset")), True).over(near))
    far = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy("file", "block").agg(F.max("at").alias("end"))
    before = ends.select("file", "block", F.last("end", True).over(far).alias("before"))
    rows = rows.join(before, ["file", "block"]).withColumn("owner", F.coalesce("at", "before"))
    tailed = rows.where("live is null").select("file", "owner").distinct().withColumn("tailed", F.lit(True))
    return rows.join(tailed, ["file", "owner"], "left").select("file", "split", "k", "offset", "owner", (F.col("tailed").isNull() & F.col("owner").isNotNull()).alias("alone"))


def _joined(cut: DataFrame, odd: DataFrame) -> DataFrame:
    """Records: pieces that are whole as they are, and the others (``odd``) put together again.

    Only the odd pieces are listed, so that the texts of ordinary archives needn't be dealt out. Pieces without an owner go.
    """
    place = ["file", "split", "k"]
    marked = cut.join(_small(odd.withColumn("odd", F.lit(True))), place, "left")
    parts = marked.where("odd and owner is not null").groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("t"))
    parts = parts.select("file", F.array_join(F.transform("t", lambda x: x["value"]), MAGIC).alias("value"))
    whole = marked.where("odd is null").select("file", "value").union(parts)
    head = F.substring_index("value", GAP, 1)
    whole = whole.select("file", head.alias("head"), F.encode("value", "UTF-8").alias("raw"), (F.octet_length(head) + len(GAP)).alias("from"))
    size = _field("Content-Length").cast("int")
    return whole.select("file", "head", F.substring(F.col("raw"), F.col("from") + 1, size).alias("body"))


def warc_digest(pages: DataFrame, compression: str = "none") -> DataFrame:
    """The digest of ``op9_warc``: the table is written as archives, which are then read back."""
    spark = pages.sparkSession
    scratch = Scratch(spark)
    path = scratch.path()
    with tidy(spark):
        write_warc(plan_records(pages), path, compression)
    back = read_warc(spark, path)
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, 'urn:page:([^>]*)', 1) as bigint)")
    back = back.select(_field("WARC-Type").alias("record_type"), _field("WARC-Record-ID").alias("id"), _field("WARC-Refers-To").alias("to"), _field("WARC-Payload-Digest").alias("told"), _field("X-Payload-Bytes").cast("long").alias("n"), "body")
    payload = F.substring(F.col("body"), F.lit(len(_HTTP) + 1), F.octet_length("body"))
    response = F.col("record_type") == "response"
    return back.select(
        page("id").alias("page_id"), F.when(response, F.octet_length(payload).cast("long")).otherwise(F.col("n")).alias("payload_bytes"),
        F.when(response, F.sha1(payload)).otherwise(F.substring_index("told", ":", -1)).alias("payload_digest"), "record_type", page("to").alias("refers_to"),
    )


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
d AS (SELECT *, sha1(h) AS g, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, g AS payload_digest,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id < last THEN last END AS refers_to
FROM d
"""
