"""Benchmark passages in documents by Wu-Manber search with words as symbols.

Patterns are the benchmark's windows: 13 consecutive words, or all words of a shorter item. For each pattern length m, a
shift table tells for every block of two words how far its last place in any pattern is from the end; a block that no
pattern holds lets the search skip m - 1 words. Where the shift is 0, the hash of the last words picks a bucket of
patterns and a direct comparison of the rest decides.

Scale: one narrow pass over the documents, no shuffle. The patterns travel as broadcasts of `SHARD_WINDOWS` windows at
most, each made from rows that stream through the driver; a benchmark of several shards costs a pass over the stored
documents for each, never a larger broadcast or task.

Nulls: a null text has no words. Items without words, or with a null text, have no window; the windows of items with a
null item_id hit words but name no item. Rows that repeat an item_id are one item.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendengine.llm.common import any_columns, fresh, stored, table, utf8, with_column

WINDOW = 13
BLOCK = 2
SUFFIX = 6
SHARD_WINDOWS = 100_000
#: A document is contaminated if one in so many of its words is hit.
SHARE = 20
#: Bytes that end words become blanks, A-Z become a-z; digits, letters and all beyond ASCII stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
KIND = "struct<n_words:bigint,spans:array<bigint>,items:array<string>>"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def windows(item: list[bytes]) -> list[tuple[bytes, ...]]:
    width = min(WINDOW, len(item))
    return [tuple(item[i : i + width]) for i in range(len(item) - width + 1)] if item else []


class Patterns:
    """Shift tables and suffix buckets of windows that all have ``length`` words."""

    def __init__(self, length: int, owners: dict[tuple[bytes, ...], set]):
        self.length, self.block, self.suffix = length, min(BLOCK, length), min(SUFFIX, length)
        self.skip = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, list] = {}
        for window, items in owners.items():
            for end in range(self.block, length + 1):
                block = window[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.skip), length - end)
            bucket = self.buckets.setdefault(window[length - self.suffix :], [])
            bucket.append((list(window[: length - self.suffix]), items))

    def find(self, text: list[bytes]) -> Iterator[tuple[int, set]]:
        """(start, items) of each occurrence, by start."""
        length, block, suffix, skip = self.length, self.block, self.suffix, self.skip
        shift, buckets = self.shift.get, self.buckets.get
        end, n = length, len(text)
        while end <= n:
            step = shift(tuple(text[end - block : end]), skip)
            if step:
                end += step
                continue
            for head, items in buckets(tuple(text[end - suffix : end]), ()):
                if text[end - length : end - suffix] == head:
                    yield end - length, items
            end += 1


def compile_patterns(pairs: list[tuple[str | None, tuple[bytes, ...]]]) -> list[Patterns]:
    by_length: dict[int, dict] = {}
    for item, window in pairs:
        owners = by_length.setdefault(len(window), {}).setdefault(window, set())
        if item is not None:
            owners.add(item)
    return [Patterns(length, owners) for length, owners in sorted(by_length.items())]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _shards(bench: DataFrame) -> Iterator[list]:
    """The benchmark's windows, at most SHARD_WINDOWS at a time; one empty shard where there are none."""
    shard, any_yet = [], False
    for row in bench.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).toLocalIterator():
        for window in windows(words(bytes(row[1]) if row[1] is not None else None)):
            shard.append((row[0], window))
            if len(shard) == SHARD_WINDOWS:
                yield shard
                shard, any_yet = [], True
    if shard or not any_yet:
        yield shard


def find_passages(spark: SparkSession, docs: DataFrame, bench: DataFrame, name: str = "found") -> DataFrame:
    """``docs`` with a struct ``name``: n_words, spans (start, end, start, end... of hit words), items (sorted ids)."""
    from pyspark.sql.types import StructType

    earlier = None
    for shard in _shards(bench):
        sent = spark.sparkContext.broadcast(shard)

        def make(sent=sent, again=earlier is not None):
            patterns = compile_patterns(sent.value)

            def work(columns):
                before = columns[1].to_pylist() if again else None
                out = []
                for k, text in enumerate(utf8(columns[0])):
                    doc = words(text)
                    spans, items = [], set()
                    if again:
                        flat = before[k]["spans"]
                        spans, items = list(zip(flat[::2], flat[1::2])), set(before[k]["items"])
                    for p in patterns:
                        for start, owners in p.find(doc):
                            items |= owners
                            if spans and spans[-1][0] <= start <= spans[-1][1]:
                                spans[-1] = (spans[-1][0], max(spans[-1][1], start + p.length))
                            else:
                                spans.append((start, start + p.length))
                    flat = [x for span in merge(spans) for x in span]
                    out.append({"n_words": len(doc), "spans": flat, "items": sorted(items)})
                return out

            return work

        kind = StructType.fromDDL(f"x {KIND}")[0].dataType
        if earlier is None:
            earlier = with_column(docs, ["text"], name, kind, make)
        else:
            earlier = stored(spark, earlier, "passages")
            again = with_column(earlier, ["text", name], fresh("again", earlier), kind, make)
            earlier = again.drop(name).withColumnRenamed(again.columns[-1], name)
    return earlier


def _n_hit(found: str):
    spans = F.col(f"{found}.spans")
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def _contaminated(found: str):
    hit = _n_hit(found)
    return (hit > 0) & (SHARE * hit >= F.col(f"{found}.n_words"))


@any_columns("text")
def drop_contaminated(spark: SparkSession, docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns as they came."""
    name = fresh("found", docs)
    return find_passages(spark, docs, bench, name).where(~_contaminated(name)).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(spark, docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        _n_hit("found").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        _contaminated("found").alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS s
  FROM item, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
hit AS (
  SELECT d.doc_id, d.i, d.m, win.item_id
  FROM (SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS s
        FROM doc, (SELECT DISTINCT m FROM win) AS k, unnest(range(1, len(w) - m + 2)) AS u(i)) AS d
  JOIN win ON win.m = d.m AND win.s = d.s),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + m)) AS u(p) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
        FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN n USING (doc_id) LEFT JOIN its USING (doc_id)
"""
