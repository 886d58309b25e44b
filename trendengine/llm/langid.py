"""Language of texts as a mixture: expectation-maximisation over n-gram likelihoods, and a penalised choice of languages.

Model: for each language, the share of every bucket of hashed letter trigrams (lower case; a blank for anything that is no
letter), with add-half smoothing, counted over all labelled training rows. Tasks count into one vector per language, `HELD` languages at a time, before
anything is shuffled. The model has `BUCKETS` numbers per language; where these are over `MODEL_BYTES`, as with dirty labels, it holds the
counts that are not 0 instead (`Counts`), with the same predictions. Whichever it is, it is broadcast; should the counts exceed `MODEL_BYTES` as well,
the labels with the fewest trigrams are not learned.

Prediction, row by row: EM finds the shares of the languages that explain the trigrams best. Then the languages with the
largest shares are taken up one after the other while the log-likelihood gains more than `PENALTY` times the log of the
number of trigrams. The prediction is the largest share, its size the score.

Training leaves out held-out rows (crc32 of the doc_id's digits, modulo 4, is 2), and rows with a null doc_id, text or
lang. ``und`` with score 0 where a text is null or has no letter, or nothing was learned. Of languages with equal shares the first by name
is predicted. Repeated training rows count as often as they come, repeated documents are judged alike. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendengine.llm.common import any_columns, fresh, table, with_column

BUCKETS = 1 << 14
MODEL_BYTES = 256 << 20
HELD = 512
PENALTY = 2.0
ROUNDS = 20
KIND = "struct<lang:string,score:double,shares:map<string,double>>"


@lru_cache(maxsize=1)
def _letters():
    """For each code point, whether it is a letter."""
    import numpy as np

    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


def trigrams(text: str | None):
    """(buckets, counts) of the hashed trigrams around each letter; none where there is no letter."""
    import numpy as np

    if not text:
        return np.empty(0, dtype=np.int64), np.empty(0)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    x = np.zeros(len(points) + 2, dtype=np.uint32)
    x[1:-1] = np.where(letter, points, 0)
    code = x[:-2] * np.uint32(2654435761) + x[1:-1] * np.uint32(2246822519) + x[2:] * np.uint32(3266489917)
    code = (code ^ (code >> np.uint32(15))) * np.uint32(668265263)
    counts = np.bincount(code[letter] >> np.uint32(18), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found].astype(float)


def held_out():
    """Rows that training must not see; a null doc_id is not one of them."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows; each task sends at most BUCKETS rows per language."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def hand_on(totals):
            for lang, total in totals.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "bucket", "n"]
                )

        totals: dict = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, counts = trigrams(text)
                if len(at):
                    total = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    total[at] += counts.astype(np.int64)
                if len(totals) > HELD:
                    yield from hand_on(totals)
                    totals = {}
        yield from hand_on(totals)

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Counts:
    """Likelihoods of many languages from the trigram counts that are not 0: ``counts[buckets]`` acts as a matrix of theirs."""

    def __init__(self, starts, langs, counts, totals):
        self.starts, self.langs, self.counts, self.totals = starts, langs, counts, totals

    def __getitem__(self, buckets):
        return _Rows(self, buckets)


class _Rows:
    """A row per bucket, a column per language; holds what is not 0, computes with add-half smoothing."""

    __array_ufunc__ = None  # so that numpy leaves products to this class

    def __init__(self, model: Counts, buckets):
        import numpy as np

        n = model.starts[buckets + 1] - model.starts[buckets]
        self.row = np.repeat(np.arange(len(buckets)), n)
        at = np.arange(len(self.row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(model.starts[buckets], n)
        self.lang, self.count, self.totals, self.n = model.langs[at], model.counts[at], model.totals, len(buckets)

    def astype(self, kind):
        return self

    def __matmul__(self, shares):
        import numpy as np

        w = shares / self.totals
        return 0.5 * w.sum() + np.bincount(self.row, self.count * w[self.lang], minlength=self.n)

    def __rmatmul__(self, x):
        import numpy as np

        return (0.5 * x.sum() + np.bincount(self.lang, self.count * x[self.row], minlength=len(self.totals))) / self.totals

    def __getitem__(self, key):
        """The columns of a few languages as an array."""
        import numpy as np

        some = key[1]
        place = np.full(len(self.totals), -1)
        place[some] = np.arange(len(some))
        here = place[self.lang] >= 0
        out = np.full((self.n, len(some)), 0.5)
        out[self.row[here], place[self.lang[here]]] += self.count[here]
        return out / self.totals[some]


def train(docs: DataFrame):
    """(languages, likelihoods): sorted names and an array of BUCKETS rows, one column per language, or `Counts`."""
    import numpy as np

    known = docs.where(F.col("doc_id").isNotNull() & ~held_out()).dropna(subset=["lang", "text"])
    packed = count_ngrams(known).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("c"), F.sum("n").alias("size"))
    packed = packed.select("lang", "size", F.col("c.bucket").alias("at"), F.col("c.n").alias("n"))  # BUCKETS values at most
    found, held = [], 0
    for row in packed.orderBy(F.desc("size"), "lang").toLocalIterator():
        held += 12 * len(row["at"])
        if held > MODEL_BYTES:
            break
        found.append((row["lang"], np.array(row["at"], dtype=np.int32), np.array(row["n"], dtype=np.float64)))
    found.sort(key=lambda x: x[0])
    langs = [x[0] for x in found]
    if len(langs) * BUCKETS * 4 <= MODEL_BYTES:
        rows = np.full((len(langs), BUCKETS), 0.5)
        for row, (_, at, n) in zip(rows, found):
            row[at] += n
        return langs, (rows / rows.sum(axis=1, keepdims=True)).astype(np.float32).T.copy()
    totals = np.array([n.sum() + BUCKETS / 2 for _, _, n in found])
    bucket = np.concatenate([at for _, at, _ in found])
    lang = np.repeat(np.arange(len(found), dtype=np.int32), [len(at) for _, at, _ in found])
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
    return langs, Counts(starts, lang[order], np.concatenate([n for _, _, n in found])[order], totals)


def mixture(likely, counts, shares):
    """EM from ``shares``: (shares, log-likelihood). ``likely``: a row per trigram, a column per language."""
    import numpy as np

    n = counts.sum()
    for _ in range(ROUNDS):
        total = likely @ shares
        after = shares * ((counts / total) @ likely) / n
        moved = np.abs(after - shares).max()
        shares = after
        if moved < 1e-3:
            break
    return shares, float(counts @ np.log(likely @ shares))


def infer(text: str | None, langs: list[str], likelihoods) -> dict:
    import numpy as np

    at, counts = trigrams(text)
    if not len(at) or not langs:
        return {"lang": "und", "score": 0.0, "shares": []}
    likely = likelihoods[at].astype(float)
    n = counts.sum()
    shares, _ = mixture(likely, counts, np.full(len(langs), 1 / len(langs)))
    order = np.argsort(-shares, kind="stable")
    chosen, best = None, -np.inf
    for k in range(1, len(langs) + 1):
        part = order[:k]
        start = np.maximum(shares[part], 1e-6)
        part_shares, fit = mixture(likely[:, part], counts, start / start.sum())
        fit -= PENALTY * np.log(n + 1) * k
        if fit <= best:
            break
        chosen, best = (part, part_shares), fit
    part, part_shares = chosen
    top = int(np.lexsort((part, -part_shares))[0])
    score = min(1.0, float(part_shares[top]))
    return {"lang": langs[part[top]], "score": score, "shares": [(langs[i], float(s)) for i, s in zip(part, part_shares)]}


def identify(spark: SparkSession, docs: DataFrame, model, name: str = "language") -> DataFrame:
    """``docs`` with a struct ``name``: lang, score, shares of all languages chosen."""
    sent = spark.sparkContext.broadcast(model)

    def make():
        langs, likelihoods = sent.value
        return lambda columns: [infer(text, langs, likelihoods) for text in columns[0].to_pylist()]

    return with_column(docs, ["text"], name, StructType.fromDDL(f"x {KIND}")[0].dataType, make)


@any_columns("doc_id", "text", "lang")
def drop_unidentified(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents in a learned language, with their columns as they came; ``und`` goes."""
    name = fresh("language", docs)
    found = identify(spark, docs, train(docs), name)
    return found.where(F.col(f"{name}.lang") != "und").drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(spark, docs.select("doc_id", "text"), train(docs))
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )
