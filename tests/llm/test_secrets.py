"""Spans against Python's matcher, trigram queries, candidates, odd rows."""

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from edgeframe.llm import secrets
from edgeframe.plans.inspect import plan_text

SCHEMA = "doc_id long, text string, key string, th string, spans string, kinds int"


def brute(text):
    found = []
    for place, r in enumerate(secrets.RULES):
        for m in re.finditer(r.pattern, text or ""):
            if len(m[r.group]) >= r.least:
                found.append((m.start(), place, m.end(), r.kind))
    return sorted(found)


def listed(found):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in found)


def expected(doc_id, text):
    found = brute(text)
    base = [f for f in found if f[1] < 3]
    n = [sum(f[3] == k for f in base) for k in ("assign", "access", "hex")]
    return (doc_id, *n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(found))


TEXTS = [
    None, "", "plain words", "é ünï PassWord = 'abcdefghijkl' x", "token=short", "token=api_key: abcdefghijklmnop",
    "API_KEY:\"" + "Z" * 40 + "\" and apikey=123456789012", "password = 'a' secret: bbbbbbbbbbbbbbbb", "AKIA" + "B" * 13 + " AKIA" + "C" * 14,
    "AKIAAKIA" + "D" * 20, "0123456789abcde 0123456789abcdef " + "f" * 100, "a" * 15 + "g" + "b" * 16,
    "-----BEGIN RSA PRIVATE KEY----- x -----BEGIN PRIVATE KEY-----", "ghp_" + "a" * 36 + " gho_" + "Z9" * 20, "xoxb-12345-abcdefgh",
    "AIza" + "x" * 35, "sk_live_" + "1" * 24, "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJ_-", "postgres://user:pa55@host/db",
    "日本 token: 日本日本", "tokentokentoken==" + "q" * 12, "\n".join(f"secret = {i:012d}zz" for i in range(2500)),
    "0" * 16 + " " + "x " * 60000 + "f" * 20, "SECRET" + " " * 5000 + "=" + " " * 5000 + "abcabcabcabcabc"]


def test_spans_like_the_plain_matcher(spark):
    rows = [(i, t, "k", "t", "s", 1) for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], "k", "t", "s", 1)] * 2 + [(3, TEXTS[3], "", "", "", 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r) for r in secrets.scanned(docs).collect()), key=str)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=str)
    assert got and secrets.scanned(docs.limit(0)).count() == 0


def test_no_python_on_the_main_path(spark, sf):
    text = plan_text(secrets.scanned(spark.read.parquet(f"{sf}/documents.parquet")))
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


def test_queries_of_known_patterns():
    q = secrets.trigram_query
    assert q("AKIA[A-Z0-9]{14,}") == frozenset([frozenset(["aki", "kia"])])
    assert q("[0-9a-f]{16,}") == secrets.EVERYTHING and q("ab|abcd") == secrets.EVERYTHING
    assert q("(abc|xyz)+") == frozenset([frozenset(["abc"]), frozenset(["xyz"])])
    assert q("ab?cd") == frozenset([frozenset(["acd"]), frozenset(["abc", "bcd"])])
    assert q("(abc)*") == secrets.EVERYTHING and q("É É É") == secrets.EVERYTHING
    assert q("abc.*xyz") == frozenset([frozenset(["abc", "xyz"])])


PARTS = st.sampled_from(["abc", "x", "[ab]", "[0-9]+", "(foo|bar|b)", "q?", "(no)?", "z{2}", "(yes){2,3}", ".*", "(a|bc)d", "\\x20*", "^", "W"])


@settings(max_examples=150, deadline=None)
@given(st.lists(PARTS, min_size=1, max_size=6), st.integers(0, 10**6))
def test_every_match_satisfies_the_query(parts, seed):
    pattern = "".join(parts)
    rng = random.Random(seed)
    pieces = ["abc", "foo", "bar", "b", "yes", "no", "zz", "ad", "bcd", "W", "q", "x", "1", " ", "a"]
    query = secrets.trigram_query(pattern)
    for _ in range(20):
        text = "".join(rng.choices(pieces, k=8))
        if re.search(pattern, text):
            assert any(all(t in text.lower() for t in x) for x in query)


def test_candidates_are_few_and_lose_none(spark, sf):
    docs = secrets.keyed(spark.read.parquet(f"{sf}/documents.parquet"))
    found = {(r.key, k) for r in secrets.candidates(docs, secrets.RULES).collect() for k in r.kinds}
    true = {(r.key, s[3]) for r in docs.collect() for s in brute(r.text) if s[3] != "hex"}
    assert true <= found and len({k for k, _ in found}) < docs.count() / 2
    only = [r for r in secrets.RULES if r.kind == "hex"]
    assert secrets.candidates(docs, only).count() == 0
