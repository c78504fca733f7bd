"""URL filters by a sort-merge range join (operator 6).

A host's labels are reversed and joined by ``\\x01``; a rule then covers one
interval of keys, namely its own host (key ``canon \\x00``) and all subdomains
(``canon \\x01 ...``), and the intervals of all rules nest.  URLs and rules are
dealt out by ranges of the key; a rule goes to each range that its interval
touches.  Each range is sorted and swept once: a stack holds the rules active
at the current key, grouped by host, and a URL takes the longest active rule
whose path is a prefix of its path.

Range bounds come from a bounded sample of the URLs' keys.  Keys end in the
path and a salt, so one host, or one URL that is repeated many times, spreads
over several ranges.  The sweep holds one stack and one batch.

Defined results: a null url or one without ``://`` has empty host and path and
no rule; of rules of equal length the longer host wins, then the smaller
string; of a rule given twice with both verdicts ``block`` wins; rules with a
null host are ignored, a null path counts as ``/``; repeated rows are judged
each; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: keys sampled for each range
SAMPLED = 40


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "\x01"), F.lit("\x00"))


class Sweep:
    """The stack of active rules, one level a host."""

    def __init__(self):
        self.levels: list[tuple[str, str, dict, list]] = []  # canon, host, path -> verdict, lengths

    def leave(self, key: str) -> None:
        while self.levels and not (key.startswith(self.levels[-1][0]) and key[len(self.levels[-1][0])] in "\x00\x01"):
            self.levels.pop()

    def enter(self, canon: str, host: str, path: str, verdict: str) -> None:
        if not self.levels or self.levels[-1][0] != canon:
            self.levels.append((canon, host, {}, []))
        _, _, paths, lengths = self.levels[-1]
        paths[path] = "block" if "block" in (verdict, paths.get(path)) else verdict
        if len(path) not in lengths:
            bisect.insort(lengths, len(path))

    def best(self, host: str, path: str) -> tuple[str | None, str | None]:
        found = None
        for _, rule_host, paths, lengths in self.levels:
            if host != rule_host and not host.endswith("." + rule_host):
                continue
            for n in reversed(lengths[:bisect.bisect_right(lengths, len(path))]):
                verdict = paths.get(path[:n])
                if verdict is not None:
                    # longer hosts come later on the stack and win ties
                    if found is None or len(rule_host) + n >= found[0]:
                        found = (len(rule_host) + n, rule_host + path[:n], verdict)
                    break
        return found[1:] if found else (None, None)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``;
    ``rules(host, path, verdict)``."""
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType.simpleString()
    url = F.col(url_col).cast("string")
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    salt = F.hex(F.xxhash64("page_id", "host", "path"))
    urls = urls.withColumn("key", F.concat(host_key(F.col("host")), F.col("path"), F.lit("\x00"), salt))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # at most SAMPLED keys a range reach the driver
    sample = sorted(r[0] for r in urls.select("key").orderBy(F.xxhash64("key"), "key").limit(SAMPLED * parts).collect())
    cuts = sorted({sample[i * len(sample) // parts] for i in range(1, parts)}) if sample else []

    def with_part(batches):
        for batch in batches:
            part = [bisect.bisect_right(cuts, k) for k in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, type=pa.int32())],
                                             [*batch.schema.names, "part"])

    urls = urls.mapInArrow(with_part, f"page_id {kind}, host string, path string, key string, part int")
    urls = urls.select("part", "key", F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict"))

    def spread(batches):
        """A rule at the start of its interval and at each cut inside it."""
        for batch in batches:
            out = []
            for host, path, verdict, key in zip(*(c.to_pylist() for c in batch.columns)):
                canon = key[:-1]
                lo, hi = bisect.bisect_right(cuts, key), bisect.bisect_left(cuts, canon + "\x02")
                out.append((lo, key, host, path, verdict))
                out += [(i + 1, cuts[i], host, path, verdict) for i in range(lo, hi)]
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "key", "host", "path", "verdict"), x)) for x in out], schema=schema)

    schema = pa.schema([("part", pa.int32()), *((c, pa.string()) for c in ("key", "host", "path", "verdict"))])
    lower = F.translate(F.col("host").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    marks = (rules.where("host is not null").select(lower.alias("host"), F.coalesce("path", F.lit("/")).alias("path"), "verdict")
             .withColumn("key", host_key(F.col("host")))
             .mapInArrow(spread, "part int, key string, host string, path string, verdict string"))
    marks = marks.select("part", "key", F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("page_id"), "host", "path", "verdict")

    def sweep(batches):
        stack, part = Sweep(), None
        for batch in batches:
            ids, out = batch.column("page_id"), []
            cols = (batch.column(c).to_pylist() for c in ("part", "key", "kind", "host", "path", "verdict"))
            for row, (p, key, is_url, host, path, verdict) in enumerate(zip(*cols)):
                if p != part:
                    stack, part = Sweep(), p
                stack.leave(key)
                if not is_url:
                    stack.enter("\x01".join(reversed(host.split("."))), host, path, verdict)
                    continue
                rule, verdict = stack.best(host, path)
                out.append((row, host, path, rule, verdict or default))
            if out:
                rows, *rest = zip(*out)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), *(pa.array(x, type=pa.string()) for x in rest)],
                                                 ["page_id", "host", "path", "rule", "verdict"])

    # a range's marks are few beside its URLs; outer rules first where several start at a cut
    every = urls.union(marks).withColumn("depth", F.length("host"))
    return (every.repartitionByRange(parts, "part").sortWithinPartitions("part", "key", "kind", "depth", "host", "path")
            .mapInArrow(sweep, f"page_id {kind}, host string, path string, rule string, verdict string"))
