"""WARC archives: a writer, and a reader that verifies the chain of records.

Writing: one record a row, as text whose line separator is the blank lines that
end a record, so Spark's own writer makes the files. Payloads that occur again
are written once, as the response of the largest id; the others revisit it.

Reading: a file is split at the version line that begins a record, in Spark's own
byte ranges, so no task needs the whole file. A payload may hold such a line too.
So each piece is only a candidate: it begins at some offset and its header
names the offset of its successor. The first piece of a file begins a record;
others do if the chain from the file's start reaches them. Chains are
followed inside each byte range, where a candidate's exit is the first offset
beyond the range; between ranges, exits are doubled (pointer jumping) until
every range entry that the start reaches is marked.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cityscan.llm.common import drop_table, shared_table, with_ids

#: The line that begins a record, and the ends of a header and of a record.
MAGIC = "WARC/1.1\r\n"
HEADER_END = "\r\n\r\n"
RECORD_END = "\r\n\r\n"

#: Payloads shorter than this are never revisited.
LEAST_REVISIT = 1000


# ---------------------------------------------------------------- writing


def _safe(value: Column) -> Column:
    """A header value: no line ends."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"[\r\n]+", " ")


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``(__id, __h, refers_to)`` of the rows of ``pages(__id, __h, __n)`` whose payload (digest
    ``__h``, at least ``least`` bytes) a larger id has too.

    Only ids and digests are shuffled; the largest id of a digest is found by
    grouped maxima, so a payload that a third of all rows share is pre-aggregated.
    """
    d = pages.where(F.col("__n") >= least).select("__id", "__h")
    last = d.groupBy("__h").agg(F.max("__id").alias("refers_to"), F.count(F.lit(1)).alias("c")).where("c > 1")
    return d.join(last.drop("c"), "__h").where("__id < refers_to").distinct()


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Write one record a row to ``path``.

    A null payload is empty. The key identifies a row: rows that share one are
    each written, and are responses unless a larger key has the same payload. A
    null key writes a response that nothing refers to.
    """
    p = pages.select(F.col(key).alias("__id"), F.col(url).cast("string").alias("__url"),
                     F.coalesce(F.col(payload), F.lit("")).alias("__payload"))
    p = p.withColumn("__n", F.octet_length("__payload")).withColumn("__h", F.sha2(F.col("__payload").cast("binary"), 256))
    p = with_ids(p, shared_table(revisits(p), "warc-revisits"), ["__id", "__h"], "left")
    digest = F.sha1(F.col("__payload").cast("binary"))
    size = F.col("__n").cast("string")
    ident = F.coalesce(F.col("__id").cast("string"), F.lit(""))
    again = F.col("refers_to").isNotNull()
    body = F.when(again, F.lit("")).otherwise(F.col("__payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), ident, F.lit(">"))),
        F.when(again, line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))))
        .otherwise(F.lit("")),
        line("WARC-Target-URI", _safe(F.col("__url"))),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line("X-Payload-Length", size),
        F.lit("Content-Type: text/html\r\n"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit(HEADER_END)),
        body)
    p.select(record.alias("value")).write.option("lineSep", RECORD_END).text(path)


# ---------------------------------------------------------------- reading


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The files under ``path`` cut at the version line: ``(file, block, seq, body, n)``.

    ``body`` is what follows the line, ``n`` its bytes; ``block`` is the start of the byte
    range that a task read and ``seq`` orders the pieces of a range. The first piece of a
    file is the (empty) text before its first line.
    """
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("seq"), F.col("value").alias("body"),
                    F.octet_length("value").cast("long").alias("n")))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row a piece: its offset, its end, the successor its header names, and its fields.

    The payload's digest is taken in place if the piece is the whole record; it is
    null if the payload holds a version line or the piece is no record.
    """
    header = F.when(F.instr("body", HEADER_END) > 0, F.substring_index("body", HEADER_END, 1))
    field = lambda name: F.regexp_extract("header", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    p = pieces(spark, path).withColumn("header", header)
    p = p.select("file", "block", "seq", "n", "body", F.octet_length("header").cast("long").alias("head"),
                 F.expr("try_cast(regexp_extract(header, '(?:^|\\r\\n)Content-Length: ([0-9]+)', 1) as bigint)").alias("size"),
                 field("WARC-Type").alias("type"), field("WARC-Record-ID").alias("id"), field("WARC-Refers-To").alias("refers"),
                 field("WARC-Payload-Digest").alias("said"), field("X-Payload-Length").alias("said_length"))
    # bytes after the version line
    p = p.withColumn("need", F.col("head") + len(HEADER_END) + F.col("size") + len(RECORD_END))
    whole = F.col("need") == F.col("n")
    payload = F.substring(F.col("body").cast("binary"), (F.col("head") + len(HEADER_END) + 1).cast("int"),
                          F.col("size").cast("int"))
    return p.select("file", "block", "seq", "n", "need", "head", "size", "type", "id", "refers", "said", "said_length",
                    F.when(whole, F.sha1(payload)).alias("digest"))


def with_offsets(p: DataFrame) -> DataFrame:
    """Adds ``offset`` (where the piece's version line starts) and ``succ`` (the next record's).

    Bytes are added up by range first, so only the range totals of one file are
    ordered together. The text before a file's first line has offset -10.
    """
    sizes = p.groupBy("file", "block").agg(F.sum(F.col("n") + len(MAGIC)).alias("bytes"))
    before = F.sum("bytes").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("file", "block", F.coalesce(before, F.lit(0)).alias("base"))
    within = F.sum(F.col("n") + len(MAGIC)).over(
        Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    p = p.withColumn("__in", F.coalesce(within, F.lit(0))).join(starts, ["file", "block"])
    p = p.withColumn("offset", F.col("base") + F.col("__in") - len(MAGIC)).drop("__in", "base")
    return p.withColumn("succ", F.col("offset") + len(MAGIC) + F.col("need"))


def _exits(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of each candidate of one byte range: the first offset outside the range that its chain leads to."""
    t = table.sort_by("offset")
    off, out = t.column("offset").to_pylist(), t.column("succ").fill_null(-1).to_pylist()
    at = {o: i for i, o in enumerate(off)}
    for i in range(len(off) - 1, -1, -1):
        j = at.get(out[i], -1)
        if j > i:
            out[i] = out[j]
    return pa.table({"file": t.column("file"), "block": t.column("block"), "offset": t.column("offset"),
                     "exit": pa.array(out, pa.int64())})


def _mark(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The records of one byte range: candidates on a chain from an entry that the file's start reaches."""
    t = table.sort_by("offset")
    entry, succ = t.column("entry").to_pylist(), t.column("succ").to_pylist()
    at = {o: i for i, o in enumerate(t.column("offset").to_pylist())}
    for i, s in enumerate(succ):
        j = at.get(s, -1)
        if entry[i] and j > i:
            entry[j] = True
    return t.select(["file", "offset"]).filter(pa.array(entry, pa.bool_()))


def record_offsets(chain: DataFrame) -> DataFrame:
    """``(file, offset)`` of the true records, from ``chain(file, block, offset, succ)``.

    Rounds of pointer jumping double the ranges an entry's pointer crosses: as
    many as the logarithm of a file's number of ranges.
    """
    one = "file string, block long, offset long, exit long"
    jump = shared_table(chain.groupBy("file", "block").applyInArrow(_exits, one), "warc-exits")
    # entries: candidates that some other range's exit points to, and each file's first record
    entries = jump.where("offset = 0").select("file", "offset")
    pointed = jump.select("file", F.col("exit").alias("offset")).distinct()
    step = shared_table(jump.join(pointed.unionByName(entries).distinct(), ["file", "offset"], "left_semi")
                        .select("file", "offset", "exit"), "warc-steps")
    reach, n = shared_table(entries, "warc-reach"), -1
    while True:
        here = step.select("file", F.col("offset").alias("o"), "exit")
        nxt = reach.join(here, (reach["file"] == here["file"]) & (reach["offset"] == here["o"])).select(
            reach["file"], F.col("exit").alias("offset"))
        reach = shared_table(reach.unionByName(nxt).distinct(), "warc-reach")
        count = reach.count()
        if count == n:
            break
        n = count
        then = step.select(F.col("file").alias("f"), F.col("offset").alias("o"), F.col("exit").alias("e"))
        step = shared_table(step.join(then, (step["file"] == then["f"]) & (step["exit"] == then["o"]), "left")
                            .select("file", "offset", F.coalesce("e", "exit").alias("exit")), "warc-steps")
    marked = chain.join(reach.withColumn("entry", F.lit(True)), ["file", "offset"], "left").select(
        "file", "block", "offset", "succ", F.coalesce("entry", F.lit(False)).alias("entry"))
    return marked.groupBy("file", "block").applyInArrow(_mark, "file string, offset long")


def _rejoined(spark: SparkSession, path: str, c: DataFrame, records: DataFrame, cut: DataFrame) -> DataFrame:
    """The digests of records whose payload holds version lines, from a second look at their pieces."""
    at = c.join(records.withColumn("start", F.col("offset")), ["file", "offset"], "left")
    owner = F.last("start", ignorenulls=True).over(
        Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = at.select("file", "block", "seq", "offset", owner.alias("start"))
    at = shared_table(at.join(cut.select("file", "start", "succ"), ["file", "start"]).where("offset < succ")
                      .select("file", "block", "seq", "start", "offset"), "warc-cut")
    body = with_ids(pieces(spark, path).drop("n"), at, ["file", "block", "seq"], "inner")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset", "body"))), lambda x: x["body"]), MAGIC)
    whole = body.groupBy("file", "start").agg(text.alias("body")).join(cut, ["file", "start"])
    payload = F.substring(F.col("body").cast("binary"), (F.col("head") + len(HEADER_END) + 1).cast("int"),
                          F.col("size").cast("int"))
    return whole.where(F.octet_length("body") == F.col("need")).withColumn("digest", F.sha1(payload))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records: ``(id, payload_bytes, payload_digest, record_type, refers_to)``, ids as text.

    Length and digest of a response are those of the payload as read; a revisit
    names its own. A file that does not begin with a record has none, and a record
    that the file's end cuts short is left out. No files give no rows.
    """
    raw = shared_table(candidates(spark, path), "warc-pieces")
    c = shared_table(with_offsets(raw).where("offset >= 0"), "warc-candidates")
    drop_table(raw)
    records = shared_table(record_offsets(c.select("file", "block", "offset", "succ")), "warc-records")
    r = c.join(records, ["file", "offset"], "left_semi")
    cols = ["type", "id", "refers", "said", "said_length", "digest", "size"]
    every = r.where("digest is not null").select(*cols)
    cut = r.where("digest is null and need is not null").withColumnRenamed("offset", "start").drop("digest", "block", "seq", "n")
    if not cut.isEmpty():
        every = every.unionByName(_rejoined(spark, path, c, records, cut).select(*cols))
    page = lambda x: F.regexp_extract(x, "<urn:page:([^>]*)>", 1)
    again = F.col("type") == "revisit"
    return every.select(
        page("id").alias("id"),
        F.when(again, F.expr("try_cast(said_length as bigint)")).otherwise(F.col("size")).alias("payload_bytes"),
        F.when(again, F.regexp_extract("said", "sha1:([0-9a-f]{40})", 1)).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(again, page("refers")).alias("refers_to"))


#: The query's rows in DuckDB SQL, from the pages themselves.
ORACLE_SQL = r"""
  WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
       q AS (SELECT *, octet_length(encode(h)) AS n, max(page_id) OVER (PARTITION BY h) AS last FROM p)
  SELECT page_id, n::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
         CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
         CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
  FROM q"""
