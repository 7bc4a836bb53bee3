r"""WARC archives: writing, and reading by boundary-chain verification (operator 3).

Archives are plain WARC files written by Spark's text writer: a record's own end mark, two line ends, is the
writer's line separator, so tasks, commits and storage are Spark's own.

Reading is splittable.  A task's rows are what lies between two magics ``WARC/1.``; Spark's text reader deals
out byte ranges of any file and hands over every row once.  The magic has no border (no start of it is an end
of it), so the reader finds it across the edges of its buffer, which it does not for one that begins with line
ends.  A row is a candidate if the row before it ends in an empty line, or if it begins its file.  The steps:

1. each candidate gives header fields, block length, so the offset where its successor must begin; a row's own
   offset is a sum of byte counts, first over the ranges of a file, then inside each range; a header that the
   magic cuts (in a foreign archive's field) is read again, put together;
2. pointer jumping: links offset -> successor are doubled (a link of 2**k records from two of 2**(k-1)) while
   the set reached from each file's start grows along them, so log2(records per file) rounds of joins on
   (path, offset) find all true records; candidates never reached are magic inside a payload;
3. a true record whose row holds its whole block is done.  Files with records that a false candidate cuts are read
   again, and the pieces from a true record up to the next are put together;
4. a chain that ends before its file does is an error, as records behind its end would be lost.

Only offsets and header fields are shuffled, payloads only in step 3 or if asked for.

Of records with equal payloads (SHA-1 and length) of at least ``min_bytes``, that with the largest id is the
response; the others become revisit records that refer to it.

Defined results: a null payload is empty; a null id is the smallest, its field is left out; repeated rows
of one id and payload are alike, responses if they hold the largest id; a null url is left out, control
characters in it are percent-encoded; an empty table gives an archive without records; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.llm.common import discard, save, table_path

CRLF = "\r\n"
EMPTY = CRLF * 2
MAGIC = "WARC/1."
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: duplicate groups up to this many (about 64 MB) are broadcast, more are joined by a shuffle
BROADCAST_GROUPS = 1_000_000


def base32(digest: Column) -> Column:
    """Upper-case base32 of 20 bytes in hex (a column, as it is read often): eight groups of five hex digits, four letters each."""
    out = []
    for g in range(8):
        n = F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(":", page_id.cast("string"), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0, date: str = "2020-01-01T00:00:00Z") -> None:
    """Write one WARC record per row to the files of folder ``path``."""
    html = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), html.alias("html"),
                        F.octet_length(html).cast("long").alias("bytes"), F.sha1(html.cast("binary")).alias("sha1")).withColumn("digest", base32(F.col("sha1")))
    same = (rows.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
            .agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    same = save(same, "equal-payloads")
    few = same.count() <= BROADCAST_GROUPS
    rows = rows.join(F.broadcast(same) if few else same, ["digest", "bytes"], "left")
    revisit = F.col("best").isNotNull() & ~F.col("best").eqNullSafe(F.col("id"))

    def fields(*pairs: tuple[str, Column]) -> Column:
        return F.concat(*[F.coalesce(F.concat(F.lit(f"{k}: "), v.cast("string"), F.lit(CRLF)), F.lit("")) for k, v in pairs])

    def only(when: Column, value: Column) -> Column:
        return F.when(when, value)

    # an escaped url can neither end a header line nor hold the magic
    url = F.replace(F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(MAGIC), F.lit("WARC%2F1."))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes"), F.lit(EMPTY))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    head = F.concat(F.lit(MAGIC + "1" + CRLF), fields(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", F.when(revisit, record_id(F.concat_ws(":", F.lit("revisit"), F.col("id"), F.monotonically_increasing_id()), F.col("digest")))
         .otherwise(record_id(F.col("id"), F.col("digest")))),
        ("WARC-Date", F.lit(date)), ("WARC-Target-URI", url), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Refers-To", only(revisit, record_id(F.col("best"), F.col("digest")))), ("WARC-Profile", only(revisit, F.lit(PROFILE))),
        ("X-Page-Id", F.col("id")), ("Content-Type", F.lit("application/http;msgtype=response")), ("Content-Length", length)))
    rows.select(F.concat(head, F.lit(CRLF), block).alias("value")).write.option("lineSep", EMPTY).text(path)


def _rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """What lies between magics: value, its bytes with the magic behind it, whether it ends in an empty line, its file
    and byte range, and its place in the range."""
    return spark.read.option("lineSep", MAGIC).text(paths).select(
        "value", (F.octet_length("value") + len(MAGIC)).cast("long").alias("n"), F.endswith("value", F.lit(EMPTY)).alias("ends"),
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("file_bytes"),
        F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("place"))


def _offsets(rows: DataFrame) -> DataFrame:
    """Add ``start``, the offset in its file of the magic before each row, and ``candidate`` (columns path, range, place, n, ends)."""
    files = Window.partitionBy("path").orderBy("range")
    ranges = rows.groupBy("path", "range").agg(F.sum("n").alias("n"), F.max_by("ends", "place").alias("ends"))
    ranges = ranges.select("path", "range", (F.sum("n").over(files) - F.col("n")).alias("base"), F.lag("ends").over(files).alias("ended"))
    places = Window.partitionBy("path", "range").orderBy("place")
    at = (rows.withColumn("inside", F.sum("n").over(places) - F.col("n")).withColumn("before", F.lag("ends").over(places))
          .join(ranges, ["path", "range"]))
    # what lies before a file's first magic has the offset -len(MAGIC)
    at = at.withColumn("start", F.col("base") + F.col("inside") - len(MAGIC))
    first = (F.col("start") == 0) | ((F.col("start") > 0) & F.coalesce("before", "ended"))
    return at.withColumn("candidate", first).drop("base", "inside", "before", "ended", "ends")


def _candidate(value: Column) -> dict[str, Column]:
    """Header fields and sizes of a row, which begins behind its magic."""
    head = F.substring_index(value, EMPTY, 1)

    def field(name: str) -> Column:
        found = F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
        return F.when(found != "", F.trim(found))

    return {
        "head": head, "head_bytes": F.octet_length("head"),
        "size": F.when(F.col("head").rlike(r"^[0-9]\r\n"), field("Content-Length").try_cast("bigint")),
        "type": field("WARC-Type"), "record_id": field("WARC-Record-ID"), "refers_to": field("WARC-Refers-To"),
        "target_uri": field("WARC-Target-URI"), "page_id": field("X-Page-Id").try_cast("bigint"),
        "content_type": field("Content-Type"), "claimed": F.regexp_replace(field("WARC-Payload-Digest"), "(?i)^sha1:", ""),
    }


def _payload(value: Column) -> dict[str, Column]:
    """The payload inside a row that holds the whole block: behind the HTTP header if there is one."""
    rest = F.substring(value, F.length("head") + len(EMPTY) + 1, F.length(value))
    http = F.when(F.lower("content_type").startswith("application/http"), F.octet_length(F.substring_index(rest, EMPTY, 1)) + len(EMPTY)).otherwise(0)
    at = F.col("head_bytes") + len(EMPTY)
    return {
        "whole": F.coalesce(F.octet_length(value) >= at + F.col("size"), F.lit(False)), "http_bytes": F.least(http.cast("long"), F.col("size")),
        "payload": F.when(F.col("whole"), F.substring(value.cast("binary"), (at + F.col("http_bytes") + 1).cast("int"), (F.col("size") - F.col("http_bytes")).cast("int"))),
        "sha1": F.sha1("payload"),
    }


def _with(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    for name, expr in steps.items():
        df = df.withColumn(name, expr)
    return df


def reachable(links: DataFrame) -> DataFrame:
    """(path, start) of the records on the chain from each file's start, of candidates (path, start, next)."""
    to = links.select(F.col("path").alias("p2"), F.col("start").alias("jump"))
    now = save(links.join(to, (F.col("path") == F.col("p2")) & (F.col("next") == F.col("jump")), "left")
               .select("path", "start", "jump", (F.col("start") == 0).alias("hit")), "jumps")
    while now.where("jump is not null").limit(1).count():
        second = now.select(F.col("path").alias("p2"), F.col("start").alias("s2"), F.col("jump").alias("j2"))
        hits = now.where("hit and jump is not null").select(F.col("path").alias("p3"), F.col("jump").alias("s3")).distinct()
        new = save(now.join(second, (F.col("path") == F.col("p2")) & (F.col("jump") == F.col("s2")), "left")
                   .join(hits, (F.col("path") == F.col("p3")) & (F.col("start") == F.col("s3")), "left")
                   .select("path", "start", F.col("j2").alias("jump"), (F.col("hit") | F.col("p3").isNotNull()).alias("hit")), "jumps")
        discard(now)
        now = new
    return now.where("hit").select("path", "start")


FIELDS = ["path", "start", "type", "record_id", "refers_to", "target_uri", "page_id", "claimed"]
HEAD = ["head_bytes", "size", *FIELDS[2:]]


def _joined(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """The rows of each owner put together: path, start (the owner's) and value (owners: path, start, owner)."""
    pieces = _offsets(rows).join(owners, ["path", "start"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "value"))), lambda x: x["value"]), MAGIC)
    return pieces.groupBy("path", "owner").agg(text.alias("value")).withColumnRenamed("owner", "start")


def _owners(placed: DataFrame, chosen: DataFrame) -> DataFrame:
    """For every row (path, start) the last chosen row (path, start) at or before it: owner."""
    last = F.max("real").over(Window.partitionBy("path").orderBy("start"))
    return (placed.select("path", "start").join(chosen.select("path", "start", F.col("start").alias("real")), ["path", "start"], "left")
            .withColumn("owner", last).where("owner is not null").drop("real"))


def _closed(spark: SparkSession, placed: DataFrame) -> DataFrame:
    """The rows with the fields of headers that a magic inside them cuts."""
    first = placed.where("candidate")
    opened = first.where("open").select("path", "start")
    files = [r.path for r in opened.select("path").distinct().collect()]  # file names only
    if not files:
        return placed
    heads = _joined(_rows(spark, files), _owners(placed, first).join(opened.withColumnRenamed("start", "owner"), ["path", "owner"], "left_semi"))
    heads = _with(heads, _candidate(F.col("value"))).select("path", "start", F.struct(*HEAD).alias("h"))
    whole = placed.join(heads, ["path", "start"], "left")
    return save(_with(whole, {c: F.when(F.col("h").isNotNull(), F.col(f"h.{c}")).otherwise(F.col(c)) for c in HEAD}).drop("h"), "placed")


def _check_ends(placed: DataFrame, records: DataFrame) -> None:
    """Raise an error if a chain of records ends before its file."""
    packed = F.col("path").rlike(r"(?i)\.(gz|bz2|deflate|zst|lz4|snappy)$")  # there the file's size is not that of its rows
    files = placed.groupBy("path").agg(F.max("file_bytes").alias("size"), (F.sum("n") - len(MAGIC)).alias("read"))
    ends = records.groupBy("path").agg(F.max("next").alias("end"))
    lost = (files.join(ends, "path", "left").select("path", F.coalesce("end", F.lit(0)).alias("end"), F.when(packed, F.col("read")).otherwise(F.col("size")).alias("bytes"))
            .where("end < bytes").orderBy("path").first())
    if lost:
        raise ValueError(f"{lost.path}: the chain of records ends at byte {lost.end} of {lost.bytes}")


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of all files of ``path``: FIELDS, payload_bytes, payload_digest and, if asked for, payload.

    ``claimed`` is the digest that the record's header states; the others are of the payload as read.
    """
    rows = _with(_rows(spark, path), _candidate(F.col("value")))
    rows = _with(rows, _payload(F.col("value")))
    light = save(rows.select(
        "path", "range", "place", "n", "ends", "file_bytes", *HEAD, "whole", (F.col("head_bytes") == F.octet_length("value")).alias("open"),
        F.length("payload").cast("long").alias("payload_bytes"), base32(F.col("sha1")).alias("payload_digest")), "candidates")
    placed = _closed(spark, save(_offsets(light), "placed"))
    placed = placed.withColumn("next", F.when(F.col("candidate"), F.col("start") + len(MAGIC) + F.col("head_bytes") + F.col("size") + 2 * len(EMPTY)))
    true = save(reachable(placed.where("next is not null").select("path", "start", "next")), "records")
    records = placed.join(true, ["path", "start"])
    _check_ends(placed, records)
    cut = [r.path for r in records.where("not whole").select("path").distinct().collect()]  # file names only
    out = records.where("whole").select(*FIELDS, "payload_bytes", "payload_digest")
    if not payload and not cut:
        return out
    whole = _joined(_rows(spark, path if payload else cut), _owners(placed, true))
    whole = _with(_with(whole, _candidate(F.col("value"))), _payload(F.col("value")))
    whole = whole.select(*FIELDS, F.length("payload").cast("long").alias("payload_bytes"), base32(F.col("sha1")).alias("payload_digest"), "payload")
    if payload:
        return whole
    broken = records.where("not whole").select("path", "start")
    return out.union(whole.drop("payload").join(broken, ["path", "start"], "left_semi"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Add to each revisit the id and payload size of the response that it refers to (columns target_page, target_bytes)."""
    responses = (records.where("type = 'response'").groupBy(F.col("record_id").alias("refers_to"))
                 .agg(F.max("page_id").alias("target_page"), F.max("payload_bytes").alias("target_bytes"), F.max("payload_digest").alias("target_digest")))
    return records.join(responses, "refers_to", "left")


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a fresh folder in the shared checkpoint folder and read the records back."""
    spark = pages.sparkSession
    path = table_path(spark, "warc")
    write_warc(pages, path, **options)
    return read_warc(spark, path)
