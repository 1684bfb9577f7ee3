"""Base rules against brute force; fertility measures and bands."""

import math
import random
import re
from collections import Counter

import public_tokenizers
import sentencepiece

from edgeframe.llm import fertility

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    again = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(again), failed


def rows():
    r = random.Random(9)
    vocab = ["the", "cat", "sat", "é#", "on", "a|b", "mat"]
    out = []
    for k in range(60):
        lines = [" ".join(r.choice(vocab) for _ in range(r.randint(0, 6))) for _ in range(r.randint(0, 8))]
        out.append((k, "\n".join(lines + r.choices(lines or ["x"], k=2)), "en"))
    return out + [(90, None, "en"), (91, "", None), (92, "слово " * 30, None), (None, "one two", None), out[0], out[0]]


def test_base_figures(spark):
    docs = spark.createDataFrame([(*r, 0, "z") for r in rows()], "doc_id long, text string, lang string, kept int, grp string")
    got = fertility.judged(docs, BYTE, PIECE).collect()
    assert sorted(tuple(r)[:7] for r in got if r.doc_id is not None) == sorted(
        (d, *brute(t)) for d, t, _ in rows() if d is not None)
    assert len(got) == len(rows()) and all(not r.kept for r in got if r.base_failed)
    assert fertility.judged(docs.limit(0), BYTE, PIECE).count() == 0


def test_measures_by_hand(spark):
    text = "ordinary words ꧁ again"
    r = fertility.measures(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"), BYTE, PIECE).collect()[0]
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    ids = [i for w in text.split() for i in sp.encode(w)]
    assert r.cpt_piece == len(text.replace(" ", "")) / len(ids)
    assert r.fallback_share == sum(sp.IsByte(i) for i in ids) / len(ids) > 0


def test_bands_reject_what_the_vocabulary_does_not_know(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").select("doc_id", "text", "lang")
    noise = " ".join("zq%dxj" % (k * 7919 % 9973) for k in range(300))
    both = docs.unionByName(spark.createDataFrame([(-1, noise, "en")], docs.schema))
    got = {r.doc_id: r for r in fertility.judged(both, BYTE, PIECE).collect()}
    assert got[-1].reason and not got[-1].kept and not got[-1].base_failed
    fine = [r for d, r in got.items() if d >= 0 and not r.base_failed]
    assert sum(r.kept for r in fine) > 0.85 * len(fine)
    kept = fertility.keep(both, BYTE, PIECE)
    assert kept.columns == both.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.kept}


def plain_measures(text, byte, sp):
    """The four measures of one text in plain Python."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    ids = [i for x in w for i in sp.encode(x)]
    chars, share = sum(map(len, w)), 0.0
    for k in range(0, len(ids), fertility.ENTROPY_BLOCK):
        part = ids[k:k + fertility.ENTROPY_BLOCK]
        bits = -sum(n / len(part) * math.log2(n / len(part)) for n in Counter(part).values())
        share += len(part) * (bits / math.log2(len(part)) if len(part) > 1 else 1.0)
    return {"cpt_byte": chars / sum(len(byte.encode_ordinary(" " + x)) for x in w), "cpt_piece": chars / len(ids),
            "fallback_share": sum(sp.IsByte(i) or sp.IsUnknown(i) for i in ids) / len(ids),
            "entropy_share": share / len(ids)}


def test_verdicts_equal_plain_python(spark, sf):
    r = random.Random(4)
    real = [(x.doc_id, x.text, x.lang) for x in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    odd = [(-1, " ".join("zq%dxj" % (k * 7919 % 9973) for k in range(300)), "en"), (-2, "꧁ ꧂ ꧁꧂ " * 9 + "a b c d e f", "en"),
           (-3, "Ω λόγος ἦν " + " ".join(r.choice("αβγδε") * 3 for _ in range(40)), None), (-4, None, "en"), (-5, "", None),
           (-6, " ".join(f"{r.choice('abcd')} {k}" for k in range(20)), "de")]
    rows = real + odd
    byte, (sp, _) = fertility.byte_vocabulary(BYTE), fertility.piece_vocabulary(PIECE)
    seen = [(d, lang or fertility.script_of(t or ""), brute_fast(t), plain_measures(t, byte, sp) if (t or "").split() else None)
            for d, t, lang in rows]
    want = {}
    for d, group, (n, failed), m in seen:
        reason = None
        for name, (side, floor) in fertility.MEASURES.items():
            values = sorted(x[name] for _, g, _, x in seen if g == group and x)
            if not m:
                continue
            low, mid, high = (values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.5, 0.75))
            off = (m[name] - mid) * math.sqrt(n / (n + fertility.STEADY))
            half = max(fertility.FENCES * (high - low), floor)
            if {"both": max(-off, off / fertility.HIGH), "high": off, "low": -off}[side] > half:
                reason = name
        want[d] = (failed, not failed and reason is None, reason)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in fertility.judged(docs, BYTE, PIECE).collect()}
    assert {d: (x.base_failed, x.kept, x.reason) for d, x in got.items()} == want
    assert {x[2] for x in want.values()} >= {None, "cpt_byte"} or {x[2] for x in want.values()} >= {None, "cpt_piece"}
    for d, _, _, m in seen:
        assert m is None or all(math.isclose(got[d][k], v, rel_tol=1e-9) for k, v in m.items())


def brute_fast(text):
    """(words, base_failed) of a text."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    count = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    again = {i + k for i in range(len(w) - 4) if count[tuple(w[i:i + 5])] > 1 for k in range(5)}
    return len(w), len(w) < 10 or 100 * len(again) > 20 * len(w)


def test_a_long_clean_text_is_not_rejected_for_its_length(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").select("doc_id", "text", "lang")
    kept = {r.doc_id for r in fertility.judged(docs, BYTE, PIECE).collect() if r.kept}
    # passages that are not repeated in five-word windows: the base rules must pass
    seen, parts = set(), []
    for r in docs.orderBy("doc_id").collect():
        w = r.text.split()
        windows = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        if r.doc_id in kept and not windows & seen:
            seen |= windows
            parts.append(r.text)
    long = "\n".join(parts)
    both = docs.unionByName(spark.createDataFrame([(-1, long, "en")], docs.schema))
    got = {r.doc_id: r for r in fertility.judged(both, BYTE, PIECE).collect()}[-1]
    short = fertility.measures(docs.limit(50), BYTE, PIECE).agg({"entropy_share": "avg"}).collect()[0][0]
    assert got.n_words > 5000 and got.kept, got
    assert abs(got.entropy_share - short) < 0.15
