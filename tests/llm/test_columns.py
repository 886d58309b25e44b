"""Every stage and operator that hands a table's columns on takes columns of any name and type."""

import pytest
from pyspark.sql import functions as F

from trendengine.llm import common, decontaminate, langid, licenses, mixing, secret_scan, sentencepiece_fst, simhash, url_filter

SF = "/root/testdata/sf0.001"
OWN = ["a.b", "own", "digest_of", "column_0_", "place", "kept", "ids", "verdict", "with space", "m", "spans"]


def odd(spark, n=40):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(f"doc_id < {n}")
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars", F.concat(F.lit("d/"), "doc_id").alias("path"), F.lit("https://example.org/en/12").alias("url"))
    extra = [F.lit(i).alias(c) for i, c in enumerate(OWN) if c != "m"] + [F.create_map(F.lit("k"), "doc_id").alias("m")]
    return docs.select("*", *extra)


STAGES = {
    "simhash": lambda s, d: simhash.keep_one(s, d),
    "decontaminate": lambda s, d: decontaminate.drop_contaminated(s, d, common.table(s, SF, "benchmark")),
    "langid": lambda s, d: langid.drop_unidentified(s, d),
    "secrets": lambda s, d: secret_scan.redact_secrets(d),
    "sentencepiece": lambda s, d: sentencepiece_fst.with_ids(s, d),
    "licenses": lambda s, d: licenses.inherit(licenses.scan(d), own="own_"),
    "urls": lambda s, d: url_filter.judge(s, d, s.sql("SELECT * FROM VALUES ('com', '/', 'block') AS t(rule_host, rule_path, verdict)")),
    "mixing": lambda s, d: mixing.mix(s, d),
}


@pytest.mark.parametrize("name", STAGES)
def test_columns_of_any_name_and_type(spark, name):
    docs = odd(spark)
    out = STAGES[name](spark, docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    assert [t for _, t in out.dtypes][: len(docs.columns)] == [t for _, t in docs.dtypes]
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    rows = {r[0]: r for r in out.collect()}
    for r in docs.collect():
        if r[0] in rows:
            assert rows[r[0]][5 : len(docs.columns)] == r[5:]
    assert rows
