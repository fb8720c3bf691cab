"""Web archives: records written as WARC files, read back, and indexed by an external merge.

*Writing.* Payloads are compared by their digests in Spark; of equal ones only the largest id keeps its
payload, the others become revisits. Spark's text writer puts one record per line with two line ends as
the line separator, which is exactly how WARC records follow each other, so every file is a complete
archive (gzip as a whole), on any store Spark can write, and safe against lost and repeated tasks.

*Reading.* Spark's text reader hands the same lines to a task, file by file; the stream is put together
again and cut by each record's ``Content-Length``, so payloads may hold anything. Every payload is
checked against its digest.

*Index.* What a task reads becomes sorted runs of captures (URL key, time, id). A range exchange deals
the runs' captures to tasks by that order, and each task merges its pieces of all runs with a loser
tree: one comparison per level of the tree and capture. The result is the history of every URL in one
global order. Many captures of one URL are split by time and id, so no task depends on one URL.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmend.llm.common import Scratch, maybe_among

#: Payloads shorter than this are never written as revisits.
REVISIT_BYTES = 1000
#: Captures sorted in memory at a time.
RUN_ROWS = 100_000
#: Captures that one task of the merge is to get, about.
RANGE_ROWS = 500_000
#: Payloads of at least every so-manieth record are joined by broadcast: at most so many.
HOT_SHARE = 10_000
#: The capture time of id 0 where the table has none; the others follow by seconds.
EPOCH = datetime.datetime(2000, 1, 1, tzinfo=datetime.timezone.utc)
SPAN = 100 * 365 * 86_400

_END = b"\r\n\r\n"
_FIXED = "http://www.iana.org/assignments/warc/"  # never a record of ours
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = ("url_key string, captured string, page_id long, url string, payload_bytes long, "
           "payload_digest string, record_type string, refers_to long, archive string, record long")
_ORDER = ("url_key", "captured", "page_id")


# -- records ----------------------------------------------------------------------------------


def url_key(url: Column) -> Column:
    """The URL with its host turned round: ``com,example,blog)/a?b``, lower case, without scheme,
    ``www.``, port 80 or 443, user and fragment. What has no host is its own key."""
    low = F.lower(F.trim(F.coalesce(url, F.lit(""))))
    rest = F.regexp_replace(F.regexp_replace(low, r"^[a-z][a-z0-9+.-]*://", ""), r"#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"^([^/?]*)", 1), r"^.*@", ""),
                            r":(80|443)$", "")
    host = F.regexp_replace(host, r"^www\d*\.", "")
    path = F.regexp_extract(rest, r"^[^/?]*(.*)$", 1)
    turned = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(host == "", low).otherwise(
        F.concat(turned, F.lit(")"), F.when(path == "", "/").otherwise(path)))


def _date(page_id: int | None) -> str:
    return (EPOCH + datetime.timedelta(seconds=(page_id or 0) % SPAN)).strftime("%Y-%m-%dT%H:%M:%SZ")


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, _FIXED + str(page_id))}>"


def _line(text: str) -> str:
    """A header value on one line: control characters and ``%`` as percent codes."""
    return re.sub(r"[%\x00-\x1f\x7f-\x9f]",
                  lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), text)


def record(page_id: int | None, url: str | None, payload: str | None, size: int, digest: str,
           refers_to: int | None, revisit: bool) -> str:
    """One record without the two line ends behind it; ``digest`` is the payload's SHA-1 in hex."""
    block = "" if revisit else payload or ""
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {_date(page_id)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")
    if revisit:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {_record_id(refers_to)}",
                 f"WARC-Payload-Length: {size}"]
        if refers_to is not None:
            head.append(f"WARC-Refers-To-Page-ID: {refers_to}")
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block.encode())}"]
    return "\r\n".join(head) + "\r\n\r\n" + block


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # records are as long as their payloads: a few at a time
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([record(
                r["page_id"], r["url"], r["html"], r["size"], r["digest"], r["refers_to"], r["revisit"])
                for r in rows], pa.string())], names=["value"])


def _parse(block: bytes) -> dict[str, str]:
    lines = block.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"no WARC record: {lines[0][:80]!r}")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}


class Reader:
    """Puts the lines of one archive together and cuts them into records by their lengths."""

    def __init__(self) -> None:
        self.head: dict[str, str] | None = None
        self.parts: list[bytes] = []
        self.size = 0

    def feed(self, line: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.parts.append(line + _END)
        self.size += len(line) + len(_END)
        while True:
            if self.head is None:
                whole = b"".join(self.parts)
                at = whole.find(_END)
                # a payload that ends in line ends leaves a last line without a separator, which
                # this stream has all the same
                if at < 0 or whole == _END:
                    self.parts = [whole]
                    return
                self.head = _parse(whole[:at])
                self.parts, self.size = [whole[at + len(_END):]], len(whole) - at - len(_END)
            need = int(self.head["content-length"])
            if self.size < need + len(_END):
                return
            whole = b"".join(self.parts)
            if whole[need:need + len(_END)] != _END:
                raise ValueError("a record is not followed by two line ends")
            yield self.head, whole[:need]
            self.head, self.parts = None, [whole[need + len(_END):]]
            self.size = len(self.parts[0])
            if not self.size:
                self.parts = []
                return

    def done(self) -> None:
        if self.head is not None or b"".join(self.parts) not in (b"", _END):
            raise ValueError("the archive ends within a record")


def _capture(head: dict[str, str], payload: bytes, archive: str, number: int) -> tuple:
    kind, digest = head["warc-type"], base64.b32decode(head["warc-payload-digest"][5:]).hex()
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"record {number} of {archive}: the payload does not have its digest")
    url = head.get("warc-target-uri")
    if url is not None:
        url = re.sub("(?:%[0-9A-F]{2})+", lambda m: bytes.fromhex(m[0].replace("%", "")).decode(), url)
    page, back = head.get("warc-page-id"), head.get("warc-refers-to-page-id")
    return (None, head["warc-date"], None if page is None else int(page), url,
            int(head["warc-payload-length"]) if kind == "revisit" else len(payload), digest, kind,
            None if back is None else int(back), archive, number)


_NAMES = [x.split()[0] for x in CAPTURE.split(", ")]
_TYPES = [pa.int64() if x.split()[1] == "long" else pa.string() for x in CAPTURE.split(", ")]


def _batch(rows: list[tuple], names: list[str] = _NAMES, types: list = _TYPES) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names=names)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, archive, number, out = Reader(), None, 0, []
    for batch in batches:
        paths, lines = batch.column(0), batch.column(1).cast(pa.large_binary())
        for i in range(batch.num_rows):
            path = paths[i].as_py()
            if path != archive:
                reader.done()
                reader, archive, number = Reader(), path, 0
            for head, payload in reader.feed(lines[i].as_py()):
                out.append(_capture(head, payload, archive.rpartition("/")[2], number))
                number += 1
                if len(out) >= 4096:
                    yield _batch(out)
                    out = []
    reader.done()
    if out:
        yield _batch(out)


def write_archives(pages: DataFrame, path: str) -> None:
    """One WARC record per row of ``page_id, url, html`` into gzip files under ``path``.

    Of equal payloads of at least 1,000 bytes, those with the largest page_id (a null one is smaller
    than all) are responses, the others revisit them. Only payloads that may have copies, told by a
    bitmap of fixed size, are joined to theirs: hot ones, 10,000 at most, by broadcast, so that no task
    gets all copies of one, the rest by an ordinary join.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    sized = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         html.alias("html"), F.octet_length(html).cast("long").alias("size"))
    # equal payloads are told by a longer digest than the one that is written
    same = F.when(F.col("size") >= REVISIT_BYTES, F.sha2(F.col("html").cast("binary"), 256))
    keyed = sized.withColumn("same", same)
    copies = Scratch(pages.sparkSession).table(keyed.where("same is not null").groupBy("same").agg(
        F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last")).where("n > 1"), "copies")
    total = copies.agg(F.sum("n")).first()[0] or 0
    alone = F.struct(F.lit(False).alias("known"), F.lit(None).cast("long").alias("last"))
    if not total:
        told = keyed.withColumn("to", alone)
    else:
        maybe = maybe_among(copies.select(F.xxhash64("same").alias("id")))(F.xxhash64("same"))
        marked = keyed.withColumn("maybe", F.col("same").isNotNull() & maybe)
        group = copies.select("same", "n", F.struct(F.lit(True).alias("known"), "last").alias("to"))
        hot, cold = (group.where(f"n * {HOT_SHARE} {sign} {total}").drop("n") for sign in (">=", "<"))
        near = marked.where("maybe").join(F.broadcast(hot.withColumnRenamed("to", "hot")), "same", "left")
        found = near.where("hot is not null").withColumnRenamed("hot", "to")
        rest = near.where("hot is null").drop("hot").join(cold, "same", "left").withColumn(
            "to", F.coalesce("to", alone))
        told = marked.where("not maybe").withColumn("to", alone).unionByName(found).unionByName(rest)
    revisit = F.col("to.known") & ~F.col("page_id").eqNullSafe(F.col("to.last"))
    told.select("page_id", "url", "html", "size", F.sha1(F.col("html").cast("binary")).alias("digest"),
                F.when(revisit, F.col("to.last")).alias("refers_to"), revisit.alias("revisit")).mapInArrow(
        _write, "value string").write.option("lineSep", _END.decode()).option(
        "compression", "gzip").text(path)


def read_archives(spark: Any, path: str) -> DataFrame:
    """Every record of the archives under ``path``, in the order of its file."""
    lines = spark.read.option("lineSep", _END.decode()).text(path).select("_metadata.file_path", "value")
    return lines.mapInArrow(_read, CAPTURE).withColumn("url_key", url_key(F.col("url")))


# -- index ------------------------------------------------------------------------------------


class LoserTree:
    """Merges sorted runs. Inner nodes hold the losers of their matches, so that the next item after
    the winner is found by replaying the matches on one path from its leaf."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.k = len(runs)
        self.heads = [next(run, None) for run in runs]
        self.losers = [-1] * self.k
        for leaf in range(self.k):
            self._play(leaf)

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's head comes first; an ended run comes last, equal heads go by run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def _play(self, leaf: int) -> None:
        """Up from the leaf: the loser stays, the winner goes on; an empty node keeps who comes first."""
        node, winner = (leaf + self.k) // 2, leaf
        while node:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = winner
                return
            if self._before(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k:
            winner = self.losers[0]
            item = self.heads[winner]
            if item is None:
                return
            yield item
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def _key(row: tuple) -> tuple:
    """Key, time, id (a missing one first), then what tells captures apart."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Captures in sorted runs; ``run`` tells those of a task apart, ``at`` is the place in the run."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    held: list[tuple] = []
    number = 0

    def packed() -> pa.RecordBatch:
        held.sort(key=_key)
        run = (task << 24) + number
        return _batch([(*row, run, at) for at, row in enumerate(held)],
                      [*_NAMES, "run", "at"], [*_TYPES, pa.int64(), pa.int64()])

    for batch in batches:
        held += zip(*(c.to_pylist() for c in batch.columns))
        if len(held) >= RUN_ROWS:
            yield packed()
            held, number = [], number + 1
    if held:
        yield packed()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of all runs that lie in this task's range, merged."""
    runs: dict[int, list[tuple]] = {}
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for run, at, row in zip(columns[-2], columns[-1], zip(*columns[:-2])):
            runs.setdefault(run, []).append((at, row))
    pieces: list[Iterable[tuple]] = []
    for run in sorted(runs):
        rows = runs.pop(run)
        rows.sort(key=lambda x: x[0])  # an exchange may hand over blocks of a run in another order
        pieces.append(((_key(row), row) for _, row in rows))
    out = []
    for _, row in LoserTree(list(pieces)):
        out.append(row)
        if len(out) >= 4096:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def capture_index(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The captures in the order of URL key, time and id, over all partitions."""
    scratch = Scratch(captures.sparkSession)
    runs = scratch.table(captures.mapInArrow(_sorted_runs, CAPTURE + ", run long, at long"), "runs")
    ranges = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                 -(-runs.count() // range_rows))
    # file and number split even captures that are alike in all else
    return runs.repartitionByRange(ranges, *_ORDER, "archive", "record").mapInArrow(_merged, CAPTURE)


def archived(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the pages as archives, reads them back and returns their merged index.

    ``path`` is a folder that does not exist yet; without one it lies in the shared folder.

    Odd input. A null html is an empty payload, a null url has the empty key, a null page_id is
    written without one (its date is that of id 0); repeated rows are records of their own, and of
    equal payloads all rows with the largest id are responses; other columns are ignored; an empty
    table makes an empty index.
    """
    scratch = Scratch(pages.sparkSession)
    where = path or f"{scratch.root}/archives"
    write_archives(pages, where)
    return capture_index(read_archives(pages.sparkSession, where))


def digest(pages: DataFrame) -> DataFrame:
    return archived(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
with sized as (
  select page_id, strlen(coalesce(html, '')) payload_bytes, sha1(coalesce(html, '')) payload_digest,
         html, max(page_id) over (partition by html) last from pages
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= {REVISIT_BYTES} and page_id is distinct from last then 'revisit'
            else 'response' end record_type,
       case when payload_bytes >= {REVISIT_BYTES} and page_id is distinct from last then last end refers_to
from sized"""
