"""Web archives: WARC files with revisit records, and one index in global order.

Tasks write captures as WARC files, each record a gzip member of its own. Reading a file back
gives a locally sorted run of index lines (URL key, timestamp, place of the record). Ranges of
the order get their part of each run, and a loser tree merges the runs of a range.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.llm.common import settle, values
from cadenza.session import scratch_folder

CRLF = b"\r\n"
#: Payloads below this length are always written as responses.
LEAST_SHARED = 100
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MADE_SCHEMA = "file string, records long"
READ_SCHEMA = (
    "page_id long, url string, url_key string, captured string, record_type string, refers_to long, "
    "payload_digest string, payload_bytes long, file string, offset long, length long, run long, place long"
)


def url_key(url: Column) -> Column:
    """The sorting form of a URL: host parts from the top down, then path and query."""
    after = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[^:/?#]*://", "")
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    rest = F.regexp_replace(F.substring(after, F.length(host) + 1, F.length(after)), r"#.*$", "")
    turned = F.array_join(F.reverse(F.split(F.regexp_replace(F.lower(host), r"^www\.", ""), r"\.")), ",")
    return F.concat(turned, F.lit(")"), F.lower(rest))


def decide(pages: DataFrame) -> DataFrame:
    """Rows (page_id, digest, refers_to): the response that a page repeats, null if it is one itself.

    The smallest id of a payload is found with partial sums; the join back carries ids only,
    and a payload with many copies is split by the adaptive join.
    """
    marks = settle(pages.select("page_id", F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("bytes")), "digests")
    firsts = marks.where(F.col("bytes") >= LEAST_SHARED).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    copies = marks.where(F.col("bytes") >= LEAST_SHARED).join(firsts, "digest").where("page_id <> first")
    return copies.select("page_id", F.col("first").alias("refers_to")).distinct()


def record(page_id: int, url: str | None, captured: str, html: str | None, refers_to: int | None) -> bytes:
    """One WARC record. A revisit keeps the HTTP head and names the payload by digest."""
    payload = (html or "").encode()
    body = HTTP_HEAD if refers_to is not None else HTTP_HEAD + payload
    target = "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "about:blank")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}')}>",
        f"WARC-Date: {captured}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        f"X-Page-Id: {page_id}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{refers_to}')}>",
            f"X-Refers-To-Page: {refers_to}",
        ]
    return CRLF.join(x.encode() for x in head) + 2 * CRLF + body + 2 * CRLF


def write_archives(captures: DataFrame, folder: str, file_bytes: int = 64 << 20) -> DataFrame:
    """Write (page_id, url, captured, html, refers_to) to WARC files; rows (file, records) name them.

    A file's name belongs to one attempt of a task, and only files in the result count, so a
    task that is run again leaves no false records behind.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, size, count, made = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*(values(c, 64) for c in batch.columns)):
                if out is None:
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, size, count = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = packer.compress(record(*row)) + packer.flush()
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    out = made.append((name, count))
        if out is not None:
            out.close()
            made.append((name, count))
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], ["file", "records"])

    return settle(captures.select("page_id", "url", "captured", "html", "refers_to").mapInArrow(write, MADE_SCHEMA), "archives")


def records_of(stream, step: int = 1 << 20) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, block) of each gzip member of an open archive."""
    offset, rest, ended = 0, b"", False
    while True:
        unpacker, parts, used = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            if not rest:
                rest = stream.read(step)
                if not rest:
                    ended = True
                    break
            parts.append(unpacker.decompress(rest))
            left = len(unpacker.unused_data)
            used += len(rest) - left
            rest = unpacker.unused_data
        if ended:
            if used:
                raise ValueError("the archive ends inside a record")
            return
        head, _, block = b"".join(parts).partition(2 * CRLF)
        fields = dict(line.decode().split(": ", 1) for line in head.split(CRLF)[1:])
        yield offset, used, fields, block[: int(fields["Content-Length"])]
        offset += used


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """Index lines of the files' records, the digest taken from the payload itself; each task's lines are a sorted run.

    A revisit's payload is not stored: its digest and length are those that its header names.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                lines = []
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for offset, length, f, block in records_of(stream):
                        kind, named = f["WARC-Type"], f["WARC-Payload-Digest"].removeprefix("sha256:")
                        payload = block.partition(2 * CRLF)[2]
                        digest = hashlib.sha256(payload).hexdigest() if kind == "response" else named
                        if digest != named:
                            raise ValueError(f"payload of page {f['X-Page-Id']} in {name} is damaged")
                        size = len(payload) if kind == "response" else int(f["X-Payload-Length"])
                        refers = f.get("X-Refers-To-Page")
                        lines.append((int(f["X-Page-Id"]), f["WARC-Target-URI"], f["WARC-Date"], kind, int(refers) if refers else None, digest, size, name, offset, length))
                columns = list(zip(*lines)) or [()] * 10
                types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                names = ["page_id", "url", "captured", "record_type", "refers_to", "payload_digest", "payload_bytes", "file", "offset", "length"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = "page_id long, url string, captured string, record_type string, refers_to long, payload_digest string, payload_bytes long, file string, offset long, length long"
    lines = files.select("file").repartition(max(1, files.count()), "file").mapInArrow(read, schema)
    runs = lines.withColumn("url_key", url_key(F.col("url"))).sortWithinPartitions("url_key", "captured", "page_id")
    # The upper bits of the id are the task, the lower ones the place in its sorted run.
    numbered = runs.withColumn("n", F.monotonically_increasing_id())
    return numbered.withColumns({"run": F.shiftright("n", 33), "place": F.col("n").bitwiseAND((1 << 33) - 1)}).drop("n")


class LoserTree:
    """Merges sorted runs: the losers of each match wait in the tree, the winner is given out."""

    def __init__(self, runs: list[Iterable]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        self.size = max(1, len(self.runs))
        self.losers = [-1] * self.size
        for leaf in range(len(self.runs)):
            self._play(leaf)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x < y or (x == y and a < b))

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.size) // 2
        while node:
            if self.losers[node] < 0:  # while the tree is built, the first to come waits
                self.losers[node] = winner
                return
            if self._before(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.runs and self.heads[top := self.losers[0]] is not None:
            yield self.heads[top]
            self.heads[top] = next(self.runs[top], None)
            self._play(top)


def merge_runs(lines: DataFrame, range_rows: int = 100_000) -> DataFrame:
    """The lines in one order over all ranges, with ``position`` in the range and ``range``.

    Ranges are cut at (URL key, timestamp, page id), so that even one URL with most captures
    is spread, and their number grows with the lines; a task holds the lines of one range.
    """
    count = lines.count()
    names = lines.columns
    ranged = lines.repartitionByRange(max(1, -(-count // range_rows)), "url_key", "captured", "page_id")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        run, place = (table.column(c).to_numpy() for c in ("run", "place"))
        order = np.lexsort((place, run))
        cuts = np.flatnonzero(np.diff(run[order])) + 1
        keys = [table.column(c) for c in ("url_key", "captured", "page_id")]
        segments = []
        for rows in np.split(order, cuts):
            taken = [k.take(pa.array(rows)) for k in keys]
            segments.append(zip(*(values(c.combine_chunks()) for c in taken), rows.tolist()))
        merged = np.fromiter((x[3] for x in LoserTree(segments)), dtype=np.int64, count=len(order))
        out = table.take(pa.array(merged))
        out = out.append_column("position", pa.array(np.arange(len(merged)))).append_column("range", pa.array(np.full(len(merged), TaskContext.get().partitionId())))
        yield from out.to_batches(max_chunksize=10_000)

    fields = ", ".join(f"{c} {t}" for c, t in lines.select(names).dtypes)
    return ranged.mapInArrow(merge, f"{fields}, position long, range long")


def archive(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", captured: Column | None = None, name: str = "warc") -> tuple[DataFrame, DataFrame, str]:
    """Write pages, read them back: (index in global order, archive files, folder).

    The index has a row for each page: its place in the archives, record type, digest and
    length of the full payload, the page it refers to, and its position. A null html is an
    empty payload, a null URL ``about:blank``. A page whose id is null is left out. Rows that
    repeat whole are one capture each; they share an id, so none revisits another. ``captured``
    is the WARC date; by default it follows the page id, a second for each. Empty tables give
    no files and an empty index.
    """
    date = captured if captured is not None else F.date_format(F.timestamp_seconds(F.lit(1_577_836_800) + F.pmod(F.col(id_column), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = pages.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), date.alias("captured"), F.col(html_column).cast("string").alias("html")
    )
    copies = settle(decide(rows), "revisits")
    folder = scratch_folder(pages.sparkSession, name)
    files = write_archives(rows.join(copies, "page_id", "left"), folder)
    lines = settle(read_archives(files, folder), "runs")
    return settle(merge_runs(lines), "index"), files, folder


def numbered(index: DataFrame) -> DataFrame:
    """The index with ``order_no``, a line's place in the one order of all ranges, from 0.

    The running count has one row for each range, and a range holds many lines.
    """
    counts = index.groupBy("range").agg(F.count("*").alias("lines"))
    before = F.coalesce(F.sum("lines").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return index.join(counts.select("range", before.alias("before")), "range").withColumn("order_no", F.col("before") + F.col("position")).drop("before")
