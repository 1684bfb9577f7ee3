"""run() against the stages' brute-force versions, one after the other."""

import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from edgeframe.llm import fertility, near_dup
from tests.llm import test_decontaminate, test_near_dup
from tests.llm.conftest import folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(21)
    vocab = ["the", "house", "river", "was", "old", "and", "near", "green", "stone", "people", "came", "from", "town",
             "market", "with", "bread", "wine", "every", "morning", "they", "walked", "over", "hills", "to", "see", "friends"]
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    texts = [prose(r.randint(30, 90)) for _ in range(30)]
    texts += [texts[0], texts[1].replace("the", "a", 1), "short one", "!!! " * 40, prose(5) + " " + texts[2][:160] + " " + prose(40)]
    bench = prose(14)
    texts += [prose(20) + " " + bench + " " + prose(20), None, ""]
    rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    return rows + [rows[4]], [(0, bench), (1, "never seen words of a benchmark item that nobody wrote")]


def test_run_equals_brute_force(spark, tmp_path):
    rows, items = corpus()
    sf = folder(spark, tmp_path, documents=spark.createDataFrame(rows, SCHEMA),
                benchmark=spark.createDataFrame(items, "item_id long, text string"))
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    ok = {(r.doc_id, r.n_words) for r in fertility.judged(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")).collect() if r.kept}
    left = [(d, t) for d, t, *_ in rows if (d, len((t or "").split())) in ok]
    assert 20 < len(left) < len(rows)
    first = corpus_pipeline.quality_rules(spark, docs, sf)
    assert sorted((r.doc_id, r.text) for r in first.collect()) == sorted(left) and first.columns == docs.columns

    idf = near_dup.idf_table(spark.createDataFrame(left, "doc_id long, text string"), near_dup.IDF_SHARE)
    classes = test_near_dup.brute(left, idf, near_dup.THRESHOLD)
    left = [(d, dict(left)[d]) for d in sorted(min(c)[1] for c in classes)]
    assert len(left) < len(ok) and 30 not in dict(left) and 31 not in dict(left)

    def cut(left):
        seen, out = set(), []
        for d, t in left:
            u = t.encode()
            hit = [False] * len(u)
            for i in range(len(u) - 99):
                if u[i:i + 100] in seen:
                    hit[i:i + 100] = [True] * 100
                seen.add(u[i:i + 100])
            out.append((d, bytes(x for x, h in zip(u, hit) if not h).decode("utf-8", "ignore")))
        return out

    shorter = cut(left)
    assert sum(a != b for a, b in zip(left, shorter)) == 1
    bad = {r[0] for r in test_decontaminate.brute(shorter, items, 10) if r[-1]}
    assert bad == {35}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t in shorter:
        if d not in bad:
            ids = library.encode(t, add_special_tokens=False).ids
            want.append((d, len(ids), sha(",".join(map(str, ids))), sha(t)))
    got = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    rows, items = corpus()
    sf = folder(spark, tmp_path, benchmark=spark.createDataFrame(items, "item_id long, text string"))
    some = spark.createDataFrame([(*r, "t", 1) for r in rows[:3]], SCHEMA + ", tag string, node int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, some, sf).columns == some.columns, name
        assert stage(spark, some.limit(0), sf).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, some.limit(0), sf).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "suffix_array_dedup",
                                                      "benchmark_decontamination", "bpe_encoding"]
