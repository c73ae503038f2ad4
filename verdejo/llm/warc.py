"""WARC archives of pages, read back and merged into globally ordered capture histories.

Writing is Spark's text writer: a record without its closing blank lines is a row, and the
closing blank lines are the line separator, so every part file is a gzip'd WARC file. Each part
is sorted by URL key and time. Reading parses the archives by their Content-Length; the capture
index is dealt out by ranges of (URL key, time, id), and each task merges the sorted runs it
receives with a loser tree.

Defined cases: null html is an empty payload; a null url has an empty target and key. Of equal
payloads the smallest page_id is the response; rows that repeat that id are all responses, rows
without an id revisit it, and are responses if no row of the group has an id. Other columns of the
input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kit import Scratch, map_batches

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
RECORDS_PER_FILE = 2_000
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
EPOCH = 1_704_067_200  # the capture time of page 0
INDEX = ("urlkey string, captured timestamp, page_id long, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, target string, archive string, place long")


def base32(hexed: Column) -> Column:
    """Base32 of a SHA-1 in hexadecimal: 20 bits at a time, so no padding occurs."""
    def four(i: Column) -> Column:
        bits = F.conv(F.substring(hexed, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*(F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def url_key(url: Column) -> Column:
    """Host labels from the right, then the rest: ``net,example,www)/path``."""
    rest = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[^:/?#]*://", ""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.substring(rest, F.length(host) + 1, F.length(rest)))


def records(pages: DataFrame) -> DataFrame:
    """page_id, urlkey, captured and the record's text."""
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha", F.sha1("html"))
    first = own.groupBy("sha").agg(F.min("page_id").alias("first"))
    df = own.join(first, "sha").withColumn("revisit", F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()))
    df = df.withColumn("captured", F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(F.pmod(F.col("page_id"), F.lit(1 << 30)), F.lit(0))))

    def line(name: str, value) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def only(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise(F.lit(""))
    block = F.when(F.col("revisit"), F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), "html"))
    number = F.col("page_id").cast("string")
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        only(number.isNotNull(), line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(number, F.lit("")), F.lit(">")))),
        only(F.col("url").isNotNull(), line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", "%0A"))),
        line("WARC-Date", F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha")))),
        line("X-Payload-Length", F.octet_length("html").cast("string")),
        only(F.col("revisit"), F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                                        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("first").cast("string"), F.lit("")), F.lit(">"))))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END))
    return df.select("page_id", url_key(F.col("url")).alias("urlkey"), "captured", F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, folder: str) -> None:
    """Part files of WARC records, each sorted by URL key, time and id."""
    (records(pages).sortWithinPartitions("urlkey", "captured", "page_id").select("record").write
     .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder))


def parse(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, header fields and block of each record."""
    at = 0
    while at < len(data):
        close = data.index(b"\r\n\r\n", at)
        fields = dict(x.split(": ", 1) for x in data[at:close].decode("utf-8", "replace").split("\r\n")[1:])
        size = int(fields["Content-Length"])
        yield at, fields, data[close + 4:close + 4 + size]
        at = close + 4 + size + len(END)


def read_archives(ws: Scratch, folder: str) -> DataFrame:
    """One index row for each record: sizes and digests of responses are taken from the payload as read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                out: dict[str, list] = {c.split()[0]: [] for c in INDEX.split(", ")}
                for place, fields, block in parse(zlib.decompress(content.as_py(), 31)):
                    row = _entry(fields, block)
                    for k, v in {**row, "archive": path, "place": place}.items():
                        out[k].append(v)
                out["captured"] = pa.array(out["captured"], pa.string()).cast(pa.timestamp("us", "UTC"))
                yield out
    files = ws.spark.read.format("binaryFile").load(folder).select("path", "content")
    raw = map_batches(files, run, INDEX.replace("urlkey string, ", ""))
    return raw.select(url_key(F.col("target")).alias("urlkey"), *(c for c in raw.columns))


def _entry(fields: dict[str, str], block: bytes) -> dict:
    def number(name: str) -> int | None:
        return int(fields[name].removeprefix("<urn:page:").removesuffix(">")) if name in fields else None
    kind = fields["WARC-Type"]
    if kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4:]
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    else:
        size, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    return {"captured": fields["WARC-Date"], "page_id": number("WARC-Record-ID"), "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "refers_to": number("WARC-Refers-To"), "target": fields.get("WARC-Target-URI")}


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner goes up; one path is replayed for each row."""

    def __init__(self, runs: list[Iterator]):
        self.runs, self.k = runs, max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.tree = [0] * self.k
        winners = [0] * (2 * self.k)
        for i in range(self.k):
            winners[self.k + i] = i
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.tree[node] = (a, b) if self._before(a, b) else (b, a)
        self.tree[0] = winners[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x, a) < (y, b)

    def __iter__(self):
        while self.heads[w := self.tree[0]] is not None:
            yield self.heads[w]
            self.heads[w] = next(self.runs[w], None)
            node = (w + self.k) // 2
            while node:
                if self._before(self.tree[node], w):
                    self.tree[node], w = w, self.tree[node]
                node //= 2
            self.tree[0] = w


def merge(index: DataFrame) -> DataFrame:
    """The index in global order: ``part`` and ``rank`` number the ranges and the rows in each."""
    keys = ("urlkey", "captured", "page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rows = pa.Table.from_batches(list(batches))  # one range of the index
        if not rows.num_rows:
            return
        key = list(zip(rows["urlkey"].to_pylist(), rows["captured"].cast(pa.int64()).to_pylist(),
                       ((x is not None, x or 0) for x in rows["page_id"].to_pylist()), range(rows.num_rows)))
        starts = [0, *(i for i in range(1, len(key)) if key[i] < key[i - 1]), len(key)]
        order = [x[-1] for x in LoserTree([iter(key[a:b]) for a, b in zip(starts, starts[1:])])]
        part = rows["part"][0].as_py()
        for at in range(0, len(order), 20_000):
            out = rows.take(pa.array(order[at:at + 20_000]))
            yield {**{c: out[c].combine_chunks() for c in out.column_names if c != "part"},
                   "rank": list(range(at, at + out.num_rows)), "part": [part] * out.num_rows}
    dealt = index.repartitionByRange(*keys).withColumn("part", F.spark_partition_id())
    return map_batches(dealt, run, INDEX + ", part int, rank long")


def captures(pages: DataFrame, ws: Scratch) -> DataFrame:
    """Archives of ``pages`` are written below the shared folder, read back and merged."""
    folder = f"{ws.root}/archives"
    write_archives(pages, folder)
    return merge(ws.keep("index", read_archives(ws, folder)))
