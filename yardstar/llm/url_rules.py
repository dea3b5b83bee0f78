"""URL filters: a sort-merge range join of urls with host and path rules."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Between labels and at the end of a reversed host. Both sort below every character of a host name, so a host and
# its subdomains form one interval: "com\x01example\x00" opens it, "com\x01example-x" lies behind it.
SEPARATOR, END = "\x01", "\x00"
DEFAULT = "allow"


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for NULL or without ``://``."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), SEPARATOR), F.lit(END))


def judge(
    urls: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rows_per_range: int = 200_000,
    sample_per_range: int = 50,
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every url under ``rules(host, path, verdict)``.

    A rule fits its host and all subdomains of it if the url's path starts with
    the rule's path. The longest rule (host and path together, then the longer
    host) wins; without one, ``rule`` is NULL and the verdict is allow.

    Hosts are reversed by label, so a rule covers one interval of keys. Urls
    are sorted by key into ranges cut at sampled keys; a key ends with a hash of
    the row, so a host with a third of all rows spreads over many ranges. Each
    rule goes to every range its interval meets. One sweep over a sorted range
    keeps the stack of the nested rules that are open; a url meets only
    those. The driver sees the cut points alone (``sample_per_range`` sampled
    keys for each range).

    NULL urls and urls without ``://`` have empty host and path, and no rule.
    Repeated rows and ids are judged row by row; rules that repeat host and
    path with different verdicts: block wins. Rules with NULL host or path are
    left out. Other columns are left out.
    """
    spark = urls.sparkSession
    rows = urls.select(
        F.col(id_col).cast("string").alias("id"),
        host_of(url_col).alias("host"),
        path_of(url_col).alias("path"),
        F.xxhash64(F.col(id_col), F.col(url_col)).alias("salt"),
    ).select("*", F.concat(reversed_host(F.col("host")), F.hex("salt")).alias("key"))
    total = urls.count()
    ranges = max(1, -(-total // rows_per_range), min(total, 2 * spark.sparkContext.defaultParallelism))
    share = min(1.0, ranges * sample_per_range / max(1, total))
    picked = F.shiftrightunsigned(F.xxhash64(F.lit(7), "salt", "key"), 33) < int(share * 2**31) + 1
    sample = sorted(r.key for r in rows.where(picked).select("key").limit(4 * ranges * sample_per_range).collect())
    cuts = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []
    known = rules.where("host IS NOT NULL AND path IS NOT NULL").select(
        F.lower("host").alias("host"), "path", "verdict"
    )
    known = known.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("block"))
    known = known.select("host", "path", "block", reversed_host(F.col("host")).alias("key"))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = pa.array([bisect_right(cuts, k) for k in b["key"].to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, part], [*b.schema.names, "part"])

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                first = bisect_right(cuts, r["key"])
                last = bisect_right(cuts, r["key"][:-1] + chr(ord(SEPARATOR) + 1))
                out += [r | {"part": p} for p in range(first, last + 1)]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([*b.schema, ("part", pa.int32())]))

    dealt = rows.drop("salt").mapInArrow(deal, "id string, host string, path string, key string, part int")
    opened = known.mapInArrow(spread, "host string, path string, block boolean, key string, part int")
    both = dealt.select("part", "key", F.lit(1).alias("kind"), "id", "host", "path", F.lit(None).cast("boolean").alias("block"))
    both = both.unionByName(
        opened.select("part", "key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("id"), "host", "path", "block")
    )

    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []  # of (open key, host, {path: block}, lengths of paths), each nested in the one before
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            columns = (b[c].to_pylist() for c in ("part", "key", "kind", "id", "host", "path", "block"))
            for p, key, kind, id_, host, path, block in zip(*columns, strict=True):
                if p != part:
                    part, stack = p, []
                while stack and not _under(key, stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, {}, set()))
                    stack[-1][2][path] = block
                    stack[-1][3].add(len(path))
                    continue
                best, blocked = "", False
                for _, rule_host, paths, lengths in stack:
                    if host != rule_host and not host.endswith("." + rule_host):
                        continue
                    n = max((n for n in lengths if path[:n] in paths), default=-1)
                    if n >= 0 and len(rule_host) + n >= len(best):
                        best, blocked = rule_host + path[:n], paths[path[:n]]
                for o, v in zip(out, (id_, host, path, best or None, "block" if blocked else DEFAULT), strict=True):
                    o.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(o, pa.string()) for o in out], ["id", "host", "path", "rule", "verdict"]
            )

    judged = (
        both.repartition(ranges, "part")
        .sortWithinPartitions("part", "key", "kind")
        .mapInArrow(sweep, "id string, host string, path string, rule string, verdict string")
    )
    return judged.select(
        F.col("id").cast(urls.schema[id_col].dataType).alias(id_col), "host", "path", "rule", "verdict"
    )


def _under(key: str, opened: str) -> bool:
    """Whether a key is the opened rule's host or a subdomain of it."""
    stem = len(opened) - 1
    return key[:stem] == opened[:stem] and key[stem : stem + 1] in (END, SEPARATOR)
