"""WARC archives: writing with payload de-duplication, and reading by boundary-chain verification.

Writing: a record per page.  Of pages with equal payloads of at least ``LEAST`` bytes, that with the
smallest id is a ``response``, the others are ``revisit`` records without a body that refer to it.

Reading: archives are cut anywhere into blocks, so a task can't know where a record starts; the
record's first line may also occur inside a payload.  Each task emits every place of that line as a
candidate, with the offset where its record would end, from its own header.  Pointer jumping from
offset 0 of each file then marks the candidates that the chain of records really reaches - 1, 2, 4 ...
records further in each round - and all others are dropped.  Payloads that contain the line are put
together again from the pieces.

Scale: blocks are read in parallel however long a file is.  Candidates are a few numbers each; chains
are followed inside a block first, so a file of n blocks takes about log2(n) rounds of joins.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.llm.common import shared_folder, stored

LEAST = 100
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ": "), value, F.lit("\r\n"))


def records_of(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``pages`` (page_id, url, html) with payload, digest, n_bytes, first (the page that a revisit
    refers to, null for a response).

    A null html is an empty payload.  Rows that repeat the smallest id are responses like it; rows
    with a null id are revisits of it, or responses where no equal payload has an id.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn(
        "n_bytes", F.octet_length("payload").cast("long"))
    # written first, so that its size is known: where few payloads repeat, no page is shuffled
    light = stored(rows.where(F.col("n_bytes") >= least).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
    return rows.join(light, "digest", "left").withColumn(
        "first", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")))


def write_archives(pages: DataFrame, path: str, least: int = LEAST) -> None:
    """One WARC file per task, uncompressed."""
    r = records_of(pages, least)
    revisit = F.col("first").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(F.col(c).cast("string")), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit(MAGIC), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", name("page_id")), _line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        _line("WARC-Target-URI", F.coalesce(F.regexp_replace("url", r"[\r\n]", ""), F.lit(""))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("WARC-Payload-Length", F.col("n_bytes").cast("string")),
        F.when(revisit, F.concat(_line("WARC-Refers-To", name("first")), _line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")), F.lit("\r\n"))
    r.select(F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload"))).alias("value")
             ).write.option("lineSep", END).text(path)


_CANDIDATE = ("file string, block long, at long, size long, known boolean, type string, id string, refers string, uri string, "
              "declared string, declared_bytes long, body long, n long, whole boolean, digest string, payload binary")


def _parse(value: bytes) -> dict | None:
    """Header fields of what follows the first line of a record; None if it has no proper header."""
    stop = value.find(b"\r\n\r\n")
    if stop < 0:
        return None
    fields = {}
    for line in value[:stop].split(b"\r\n"):
        key, colon, rest = line.partition(b":")
        if not colon:
            return None
        fields[key.strip().lower()] = rest.strip().decode("utf-8", "replace")
    try:
        n = int(fields[b"content-length"])
    except (KeyError, ValueError):
        return None
    fields["body"], fields["n"] = stop + 4, n
    return fields if n >= 0 else None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """What lies between the record lines, in file order within a block; Spark cuts the files."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block")))


def candidates(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every place of the record line, with the header found there.  ``at`` counts from the end of the
    block's first record line on; ``whole``: the body lies before the next candidate."""
    schema = _CANDIDATE
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    types = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    kinds = [types[c.strip().split(" ")[1]] for c in schema.split(",")]

    def run(batches):
        here, at = None, 0
        for batch in batches:
            rows = []
            for value, file, block in zip(*(batch.column(c) for c in ("value", "file", "block"))):
                value, file, block = value.as_py(), file.as_py(), block.as_py()
                if (file, block) != here:
                    here, at = (file, block), 0
                size = len(value) + len(MAGIC)
                f = _parse(value)
                if f is None:
                    rows.append((file, block, at, size, False) + (None,) * 11)
                else:
                    body, n = f["body"], f["n"]
                    whole = body + n + len(END) <= len(value)
                    payload = value[body:body + n] if whole else None
                    declared = f.get(b"warc-payload-length", "")
                    rows.append((file, block, at, size, True, f.get(b"warc-type"), f.get(b"warc-record-id"),
                                 f.get(b"warc-refers-to"), f.get(b"warc-target-uri"),
                                 f.get(b"warc-payload-digest", "").rpartition(":")[2],
                                 int(declared) if declared.isdigit() else None, body, n, whole,
                                 hashlib.sha256(payload).hexdigest() if whole else None, payload if payloads else None))
                at += size
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else
                                             [pa.array([], k) for k in kinds], names=names)

    return _lines(spark, path).mapInArrow(run, schema)


def with_offsets(found: DataFrame) -> DataFrame:
    """Adds ``start`` (where the text after the record line begins in its file), ``offset`` (of the
    line itself) and ``next`` (of the line that should follow; null without a proper header)."""
    blocks = found.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    before = F.sum("bytes").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    bases = blocks.select("file", "block", F.coalesce(before, F.lit(0)).alias("base"))
    line = len(MAGIC)
    return (found.join(bases, ["file", "block"])
            .withColumn("start", F.col("base") + F.col("at")).withColumn("offset", F.col("start") - line)
            .withColumn("next", F.when(F.col("known"), F.col("start") + F.col("body") + F.col("n") + len(END))).drop("base"))


def _exit_of(offsets: list[int], following: list) -> list:
    """For each candidate of a block (rising offsets), the first offset on its chain that is not a
    candidate of the block, or None where the chain ends there."""
    exits: dict[int, int | None] = {}
    for offset, after in zip(reversed(offsets), reversed(following)):
        exits[offset] = exits.get(after, after)      # a record ends behind its start: known already
    return [exits[o] for o in offsets]


def _block_exits(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("offset")
    exits = _exit_of(rows.column("offset").to_pylist(), [None if n is None else int(n) for n in rows.column("next").to_pylist()])
    return pa.table({"file": rows.column("file"), "offset": rows.column("offset"), "next": pa.array(exits, pa.int64())})


def _block_chain(rows: pa.Table) -> pa.Table:
    """The candidates of a block on the chain from its entry (``entry`` is true for one at most)."""
    rows = rows.sort_by("offset")
    after = dict(zip(rows.column("offset").to_pylist(), rows.column("next").to_pylist()))
    at = next((o for o, e in zip(rows.column("offset").to_pylist(), rows.column("entry").to_pylist()) if e), None)
    chain = []
    while at in after:
        chain.append(at)
        at = after[at]
    return pa.table({"file": pa.array(rows.column("file").to_pylist()[:1] * len(chain), pa.string()),
                     "offset": pa.array(chain, pa.int64())})


def reachable(pointers: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that the chain from offset 0 of each file reaches.
    ``pointers``: file, block, offset, next of every candidate.

    Inside a block (bounded bytes, so bounded candidates) the chain is followed at once; between
    blocks pointers are jumped, twice as far in each round.
    """
    rows = pointers.where("offset >= 0").select("file", "block", "offset", "next")
    jump = stored(rows.groupBy("file", "block").applyInArrow(_block_exits, "file string, offset long, next long"), "jumps")
    known = stored(jump.where("offset = 0").select("file", "offset"), "entries")
    total = known.count()
    while True:
        further = known.join(jump, ["file", "offset"]).where("next IS NOT NULL").select("file", F.col("next").alias("offset"))
        further = further.join(jump.select("file", "offset"), ["file", "offset"], "left_semi")
        known = stored(known.union(further), "entries")
        now = known.count()
        if now == total:
            break
        total = now
        onward = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("beyond"))
        jump = stored(jump.join(onward, ["file", "next"], "left").select("file", "offset", F.col("beyond").alias("next")), "jumps")
    entered = rows.join(known.withColumn("entry", F.lit(True)), ["file", "offset"], "left")
    return entered.groupBy("file", "block").applyInArrow(_block_chain, "file string, offset long")


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of all archives under ``path``: file, offset, type, id, refers, uri, declared
    (digest in the header), declared_bytes, n (bytes of the body), digest (of the body read) and, if
    asked for, payload.  A chain that breaks off (a damaged header or length) ends its file."""
    found = with_offsets(stored(candidates(spark, path, payloads), "candidates"))
    chain = stored(reachable(found), "chain")
    records = found.join(chain, ["file", "offset"])
    out = ["file", "offset", "type", "id", "refers", "uri", "declared", "declared_bytes", "n", "digest", "payload"]
    cut = records.where("NOT whole").select("file", "offset", "start", "body", "n", "next")
    if cut.isEmpty():
        return records.select(out)
    # bodies with the record line inside: each later piece belongs to the last record before it
    marked = found.select("file", "block", "at", "start", "offset").join(
        chain.withColumn("owner", F.col("offset")), ["file", "offset"], "left")
    order = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    pieces = (marked.withColumn("owner", F.last("owner", ignorenulls=True).over(order))
              .join(cut.select("file", F.col("offset").alias("owner")), ["file", "owner"], "left_semi")
              .select("file", "block", "at", "start", "owner"))

    def placed(batches):
        here, at = None, 0
        for batch in batches:
            places = []
            for value, file, block in zip(*(batch.column(c) for c in ("value", "file", "block"))):
                key = (file.as_py(), block.as_py())
                if key != here:
                    here, at = key, 0
                places.append(at)
                at += len(value.as_buffer()) + len(MAGIC)
            yield batch.append_column("at", pa.array(places, pa.int64()))

    lines = _lines(spark, path).mapInArrow(placed, "value binary, file string, block long, at long")
    texts = (lines.join(pieces, ["file", "block", "at"]).groupBy("file", F.col("owner").alias("offset"))
             .agg(F.sort_array(F.collect_list(F.struct("start", "value"))).alias("p")))
    magic = F.lit(MAGIC).cast("binary")
    joined = F.aggregate(F.slice("p", 2, F.size("p")), F.element_at("p", 1)["value"],
                         lambda acc, x: F.concat(acc, magic, x["value"]))
    bodies = (texts.join(cut, ["file", "offset"])
              .select("file", "offset", F.substring(joined, F.col("body").cast("int") + 1, F.col("n").cast("int")).alias("b")))
    bodies = bodies.select("file", "offset", F.sha2("b", 256).alias("b_digest"), *([F.col("b")] if payloads else []))
    mended = records.join(bodies, ["file", "offset"], "left").withColumn("digest", F.coalesce("digest", "b_digest"))
    if payloads:
        mended = mended.withColumn("payload", F.coalesce("payload", "b"))
    return mended.select(out)


def _page(name: str, kind) -> Column:
    inner = F.url_decode(F.regexp_extract(name, "^<urn:page:(.*)>$", 1))
    return F.when(inner != "", inner.cast(kind))


def op6_query(pages: DataFrame) -> DataFrame:
    path = shared_folder(pages.sparkSession, "warc")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    got = read_archives(pages.sparkSession, path)
    revisit = F.col("type") == "revisit"
    return got.select(
        _page("id", kind).alias("page_id"), F.when(revisit, F.col("declared_bytes")).otherwise(F.col("n")).alias("payload_bytes"),
        F.when(revisit, F.col("declared")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(revisit, _page("refers", kind)).alias("refers_to"))


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS digest,
         CAST(strlen(coalesce(html, '')) AS BIGINT) AS n
  FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest
"""
