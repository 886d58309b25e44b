"""Secret scan against plain patterns, and its tests on random and ordinary tokens."""

import hashlib
import random
import re
import string

from hypothesis import given, settings
from hypothesis import strategies as st

from trendengine.llm import secret_scan as s

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, secrets string, n_chars long"


def plain_base(text):
    kinds = [
        ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    ]
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, ok) in enumerate(kinds) for m in re.finditer(p, text or "") if ok(m)]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "TOKEN", "api_key", "APIKEY", '"', "'", " ", "=", ":", "AKIA", "A1B2C3D4", "0123abcd", "é", "x", "ſecret", "\n", "K"]), max_size=25))
def test_base_spans_are_the_plain_ones(parts):
    text = "".join(parts)
    base, added = s.scan(text)
    assert base == plain_base(text)
    assert not any(a < e and b < d for _, a, d in added for _, b, e in base)


def test_query_against_plain_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = s.query(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for k, _, _ in base) for n in s.KINDS[:3])
        got = r.spans.split(",") if r.spans else []
        assert [x for x in got if not x.startswith("random")] == (line.split(",") if line else [])
        assert [int(x.split(":")[1]) for x in got] == sorted(int(x.split(":")[1]) for x in got)
    assert any(r.n_assign for r in rows) and any(r.n_hex for r in rows)


def test_random_tokens_are_found_and_ordinary_ones_left():
    rng = random.Random(5)
    b62 = string.ascii_letters + string.digits
    keys = ["".join(rng.choice(b62) for _ in range(40)) for _ in range(200)]
    found = sum(bool(s.scan(f"see {k} there")[1]) for k in keys)
    assert found >= 180
    words = "interoperability counterrevolutionary electroencephalography pneumonoultramicroscopic internationalization".split()
    plain = words + ["".join(words), "a" * 40, "abcdefghijklmnopqrstuvwxyzabcdefgh", "0" * 30, "Path/To/Some/Module/And/Class", "snake_case_function_name_here"]
    assert not [p for p in plain if s.scan(f"the {p} of")[1]]
    assert not [p for p in plain if s.scan(" ".join(plain))[1]]


def test_random_tokens_after_names_in_queries_and_in_paths():
    rng = random.Random(7)
    b62, b64, url = (string.ascii_letters + string.digits + x for x in ("", "+/", "-_"))
    forms = [
        ("AWS_SECRET_ACCESS_KEY={}", b64), ("SESSION_ID={}", b62), ("export A_NAME_OF_MORE_THAN_20={}==", b64), ("https://x.org/a?user=me&sig={}&x=1", url),
        ("https://x.org/reset-link/{}", b62), ("/reset-link/{}", url), ("/a-b/c/{}/end-of_path", b62), ("https://x.org/some/longer/path/of-the/site/{}", b62),
    ]
    for form, alphabet in forms:
        found = 0
        for _ in range(50):
            key = "".join(rng.choice(alphabet) for _ in range(40))
            text = f"set {form.format(key)} now"
            base, added = s.scan(text)
            found += key not in s.redact(text, base + added)
        assert found >= 40, form
    plain = ["A_SETTING_WITH_A_LONG_NAME=its_value_is_ordinary_writing", "/some-path/with_names/and-more/of+them", "=" * 60, "-_" * 30 + "/", "x=" * 30]
    assert not [p for p in plain if s.scan(f"the {p} of")[1]]


def test_added_spans_never_overlap_and_repeats_are_one_test():
    rng = random.Random(9)
    url = string.ascii_letters + string.digits + "-_"
    for form in ("/reset-link/{}", "/a-b/c/{}/end-of_path", "x/{}+{}/y_{}-z"):
        for _ in range(100):
            keys = ["".join(rng.choice(url) for _ in range(40)) for _ in range(3)]
            added = s.scan(f"go {form.format(*keys)} on")[1]
            assert all(b <= c for (_, _, b), (_, c, _) in zip(added, added[1:])), added
    token = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40))
    words = "electroencephalographically"
    assert len(s.scan(f"{token} {words} " * 5)[1]) == 5
    tests = lambda n: s.scan(f"{token[:24]} " * n + f"{words} ")[1]
    assert bool(tests(1)) == bool(tests(50))


def test_length_matters():
    rng = random.Random(6)
    share = lambda n: sum(bool(s.scan("".join(rng.choice(string.ascii_lowercase) for _ in range(n)))[1]) for _ in range(200))
    assert share(20) < share(40) < share(120)


def test_redaction_nulls_long_and_empty(spark):
    key = "AKIA" + "ABCDEFGH12345678"
    docs = spark.createDataFrame(
        [(1, f"é key {key} end", "x", 5), (1, f"é key {key} end", "x", None), (2, None, None, 7), (3, "", "x", 0), (None, "plain " * 200_000, "x", 1),
         (4, 'token="0123456789abcdef0123"', "x", 1)],
        SCHEMA,
    )
    out = s.redact_secrets(docs)
    assert out.columns == docs.columns
    rows = sorted(out.collect(), key=lambda r: (r.doc_id or 0, r.text or ""))
    assert [r.text for r in rows if r.doc_id] == ["é key [SECRET] end"] * 2 + [None, "", '[SECRET]"']
    assert [r.n_chars for r in rows if r.doc_id] == [18, 18, 7, 0, 9]
    assert s.redact_secrets(docs.where("false")).count() == 0
