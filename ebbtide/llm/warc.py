"""WARC archives: writing with revisit records, reading by boundary-chain verification.

Writing. A row becomes a ``response`` record, or a ``revisit`` of the record with the smallest id
among equal payloads of at least ``min_revisit_bytes``. Records go out through Spark's text
writer, which ends each row with the two line breaks that end a record.

Reading. The magic ``WARC/1.`` may also stand inside a payload, so no task can tell from its own
bytes which magic starts a record. Spark's text source, with the magic as its line separator,
deals out the byte ranges of the files; each segment between two magics gets its offset, and each
magic becomes a candidate record with the offset of its successor (from its Content-Length). Then
pointer jumping from the start of each file, doubling the reach in every round, marks the
candidates that are reachable; magics inside payloads are not. A reachable record that holds a
magic is put together from its segments, whose owners come from the same jumping backwards.

Bytes that are no chain of records are never passed over: a chain that ends before its file does
raises an error. Large files are split freely; nothing is gathered per file.

Defined results: a null payload is empty; a null id is written as an empty one and read back as
null, and is larger than any id; rows equal in id and payload are all responses when theirs is
the smallest id; a null or odd url is percent-encoded into its header; an empty table gives no
records; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import written

MAGIC = "WARC/1."
BREAK = "\r\n"
BLANK = BREAK + BREAK
ID_PREFIX = "urn:page:"
# Fixed values of RFC 4648.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_OF_CONV = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BIN = 1_000_000  # bytes
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, from chunks of 20 bits."""
    digest = F.sha1(payload)
    chunks = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*chunks), BASE32_OF_CONV, BASE32)


def _header(value: Column) -> Column:
    """A header value on one line."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit_bytes: int = 0) -> DataFrame:
    """id, url, payload (binary), digest, refers_to (null for a response)."""
    base = pages.select(
        pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"),
        F.coalesce(pages[payload_col].cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", sha1_base32(F.col("payload")))
    first = (
        base.where(F.length("payload") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # Written, so that both sides of the join are shuffled and a hot digest can be split.
    joined = base.join(written(first, "first"), "digest", "left")
    again = F.col("first").isNotNull() & (F.length("payload") >= min_revisit_bytes) & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.withColumn("refers_to", F.when(again, F.col("first"))).drop("first")


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_revisit_bytes: int = 0, compression: str = "gzip",
) -> None:
    """One archive file per task under ``path``; plain files (``compression="none"``) can be split by readers."""
    rows = records(pages, id_col, url_col, payload_col, min_revisit_bytes)
    revisit = F.col("refers_to").isNotNull()
    name = lambda c: F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        F.length("payload").cast("string"), F.lit(BLANK),
    ).cast("binary")
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(f"{MAGIC}0{BREAK}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{BREAK}WARC-Record-ID: "), name(F.col("id")), F.lit(f"{BREAK}WARC-Date: {DATE}"),
        F.coalesce(F.concat(F.lit(f"{BREAK}WARC-Target-URI: "), _header(F.col("url"))), F.lit("")),
        F.lit(f"{BREAK}Content-Type: application/http; msgtype=response"),
        F.lit(f"{BREAK}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"{BREAK}WARC-Profile: {PROFILE}{BREAK}WARC-Refers-To: "), name(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit(f"{BREAK}Content-Length: "), F.length("block").cast("string"), F.lit(BLANK),
    )
    # The writer puts the bytes of a string out as they are and closes each row with BLANK.
    rows.withColumn("block", block).select(
        F.concat(head.cast("binary"), F.col("block")).cast("string").alias("value")
    ).write.option("lineSep", BLANK).text(path, compression=compression)


def _field(head: Column, name: str) -> Column:
    return F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)


def _number(text: Column) -> Column:
    return F.trim(text).try_cast("long")


def _head(body: Column) -> Column:
    """What stands before the first blank line, null without one; bytewise."""
    head = F.substring_index(body.cast("string"), BLANK, 1)
    return F.when(F.octet_length(head) < F.length(body), head)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """file, part, turn, size, need, body: what stands between magics, in order within a byte range.

    ``need`` is the size that a record starting here would have after its magic.
    """
    text = spark.read.option("lineSep", MAGIC).text(path)
    body = F.col("value").cast("binary")
    head = _head(body)
    need = F.octet_length(head) + 2 * len(BLANK) + _number(_field(head, "Content-Length"))
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("turn"), F.length(body).cast("long").alias("size"),
        need.cast("long").alias("need"), body.alias("body"),
    )


def _candidates(segments: DataFrame) -> DataFrame:
    """file, part, turn, at, next, end, run for every magic of the files; no bodies.

    ``at`` is the offset of the magic, ``end`` that of the next one, ``next`` that of the
    successor by Content-Length. A run is a stretch of candidates of one byte range whose
    successor is the very next magic.
    """
    step = F.col("size") + len(MAGIC)
    narrow = segments.select("file", "part", "turn", "size", "need")
    ranges = narrow.groupBy("file", "part").agg(F.sum(step).alias("bytes"))
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole_file = Window.partitionBy("file")
    bases = ranges.select(
        "file", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"),
        (F.sum("bytes").over(whole_file) - len(MAGIC)).alias("file_bytes"),
    )
    order = Window.partitionBy("file", "part").orderBy("turn")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        narrow.withColumn("local", F.coalesce(F.sum(step).over(earlier), F.lit(0)))
        .withColumn("apart", F.coalesce(F.lag(F.col("size") != F.coalesce("need", F.lit(-1))).over(order), F.lit(True)))
        .withColumn("run", F.sum(F.col("apart").cast("long")).over(order))
        .join(bases, ["file", "part"])
    )
    return placed.select(
        "file", "part", "turn", "run", (F.col("base") + F.col("local") - len(MAGIC)).alias("at"),
        (F.col("base") + F.col("local") + F.col("size")).alias("end"),
        (F.col("base") + F.col("local") + F.col("need")).alias("next"), "file_bytes",
    )


def _reachable(candidates: DataFrame) -> DataFrame:
    """file, part, run, entry: the runs on the chain from the start of their file."""
    run = ["file", "part", "run"]
    # What stands before the first magic of a file starts no record.
    starts = candidates.where("at >= 0")
    runs = starts.groupBy(*run).agg(
        F.max_by("next", "at").alias("exit"), F.max("file_bytes").alias("file_bytes")
    )
    doors = starts.select("file", F.col("at").alias("exit"), F.col("part").alias("to_part"), F.col("run").alias("to_run"))
    linked = written(runs.join(doors, ["file", "exit"], "left"), "warc-runs")
    jumps = linked.where("to_run is not null").select(*run, "to_part", "to_run", F.col("exit").alias("entry"))
    reached = written(starts.where("at = 0").select(*run, F.lit(0).cast("long").alias("entry")), "warc-reached")
    known = reached.count()
    while True:
        ahead = reached.select(*run).join(jumps, run).select(
            "file", F.col("to_part").alias("part"), F.col("to_run").alias("run"), "entry"
        )
        # A run on the chain is entered once; the smallest entry also holds for a damaged file.
        reached = written(reached.unionByName(ahead).groupBy(*run).agg(F.min("entry").alias("entry")), "warc-reached")
        if (now := reached.count()) == known:
            break
        known = now
        onward = jumps.select(
            "file", F.col("part").alias("to_part"), F.col("run").alias("to_run"),
            F.col("to_part").alias("part_2"), F.col("to_run").alias("run_2"), F.col("entry").alias("entry_2"),
        )
        jumps = written(
            jumps.join(onward, ["file", "to_part", "to_run"]).select(
                *run, F.col("part_2").alias("to_part"), F.col("run_2").alias("to_run"), F.col("entry_2").alias("entry")
            ),
            "warc-jumps",
        )
    last = reached.join(linked, run).where("to_run is null").select("file", "exit", "file_bytes")
    files = candidates.groupBy("file").agg(F.max("file_bytes").alias("size")).where("size > 0")
    broken = files.join(last, "file", "left").where("exit is null or exit <> size").select("file", "exit").take(1)
    if broken:
        raise ValueError(f"{broken[0]['file']}: no record chain beyond byte {broken[0]['exit']}")
    return reached


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, offset, record_type, record_id, url, refers_to, digest, payload_bytes, payload.

    ``payload`` is the HTTP body (null for a revisit) or the block where there is no HTTP head;
    ``payload_bytes`` is the full payload's size, from the HTTP head where it has one.
    """
    segments = written(_segments(spark, path), "warc-segments")
    candidates = written(_candidates(segments), "warc-candidates")
    reached = _reachable(candidates)
    real = written(
        candidates.join(reached, ["file", "part", "run"]).where("at >= entry").select("file", "part", "turn", "at", "next", "end"),
        "warc-records",
    )
    bodies = segments.select("file", "part", "turn", "body")
    single = real.where("next = end").join(bodies, ["file", "part", "turn"]).select("file", "at", "body")
    # A record that holds magics: its segments are found by bins of its range, then joined up.
    held = real.where("next > end").select(
        "file", F.col("at").alias("owner"), F.col("next").alias("until"),
        F.explode(F.sequence(F.floor(F.col("at") / BIN), F.floor((F.col("next") - 1) / BIN))).alias("bin"),
    )
    binned = candidates.where("at >= 0").select(
        "file", "part", "turn", "at", F.floor(F.col("at") / BIN).alias("bin")
    )
    parts = binned.join(held, ["file", "bin"]).where("at >= owner and at < until")
    joined = (
        parts.join(bodies, ["file", "part", "turn"])
        .groupBy("file", "owner")
        .agg(F.array_sort(F.collect_list(F.struct("at", "body"))).alias("parts"))
        .select(
            "file", F.col("owner").alias("at"),
            F.aggregate(
                F.slice("parts", 2, F.size("parts")), F.col("parts")[0]["body"],
                lambda whole, p: F.concat(whole, F.lit(MAGIC.encode()), p["body"]),
            ).alias("body"),
        )
    )
    head = _head(F.col("body"))
    opened = single.unionByName(joined).withColumn("head", head)
    block = F.expr(
        f"substring(body, octet_length(head) + {len(BLANK)} + 1, length(body) - octet_length(head) - {2 * len(BLANK)})"
    )
    opened = opened.withColumn("block", block)
    is_http = _field(F.col("head"), "Content-Type").startswith("application/http")
    opened = opened.withColumn("http", F.when(is_http, _head(F.col("block"))))
    payload = F.when(
        F.col("http").isNotNull(), F.expr(f"substring(block, octet_length(http) + {len(BLANK)} + 1)")
    ).otherwise(F.col("block"))
    kind = _field(F.col("head"), "WARC-Type")
    return opened.withColumn("payload", F.when(kind != "revisit", payload)).select(
        "file", F.col("at").alias("offset"), kind.alias("record_type"),
        _field(F.col("head"), "WARC-Record-ID").alias("record_id"), _field(F.col("head"), "WARC-Target-URI").alias("url"),
        F.nullif(_field(F.col("head"), "WARC-Refers-To"), F.lit("")).alias("refers_to"),
        _field(F.col("head"), "WARC-Payload-Digest").alias("digest"),
        F.coalesce(_number(_field(F.col("http"), "Content-Length")), F.length("payload").cast("long")).alias("payload_bytes"),
        "payload",
    )


def page_number(record_id: Column) -> Column:
    """The id that :func:`write_warc` put into a record's name."""
    return _number(F.regexp_extract(record_id, f"<{ID_PREFIX}([^>]*)>", 1))
